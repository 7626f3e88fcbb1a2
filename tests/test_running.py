"""Spikes against a running mean, on tables and as state of a stream."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import BASE, at, trades
from tickloom.operators import bars_1min, running_spikes
from tickloom.plans import start_flow
from tickloom.schema import ANOMALY, ENVELOPE, FULL_BAR, SHORT_BAR, TRADE
from tickloom.session import shared_path
from tickloom.sinks import ParquetTable
from tickloom.sources import envelope_files
from tickloom.streaming import start_query, wait_for_all

BARS = "symbol string, minute int, total_volume double"


def volume_table(spark, rows):
    start = F.lit(BASE.isoformat()).cast("timestamp") + F.make_interval(mins=F.col("minute"))
    return spark.createDataFrame(rows, BARS).select(
        "symbol", start.alias("window_start"), (start + F.expr("interval 1 minute")).alias("window_end"),
        "total_volume", F.lit(1.0).alias("avg_price"), F.lit(1.0).alias("vwap"),
    )


def brute(rows, factor=3.0):
    """(symbol, minute, volume, mean) by a loop over the bars in order of time."""
    held, found = {}, set()
    for symbol, minute, volume in sorted(rows, key=lambda r: r[1]):
        if symbol is None or volume is None:
            continue
        held.setdefault(symbol, []).append(volume)
        mean = sum(held[symbol]) / len(held[symbol])
        if volume > factor * mean:
            found.add((symbol, minute, volume, round(mean, 9)))
    return found


def drawn(seed, minutes=60):
    draw = random.Random(seed)
    rows = [(s, m, draw.choice([0.0, 1.0, 2.0, 9.0, 40.0])) for s in "AB" for m in range(minutes) if draw.random() < 0.8]
    return [r for r in rows if r[1] != 7] + [("A", 7, None), (None, 3, 1e9), ("C", 5, 4.0), ("N", 2, -1.0), ("N", 3, -9.0)]


def found_in(df):
    minute = ((F.unix_micros("window_start") - F.lit(int(BASE.timestamp() * 1e6))) / 60_000_000).cast("int")
    rows = df.select("symbol", minute.alias("m"), "total_volume", "avg_volume", "ratio").collect()
    assert all(r.ratio == pytest.approx(r.total_volume / r.avg_volume) for r in rows)
    return {(r.symbol, r.m, r.total_volume, round(r.avg_volume, 9)) for r in rows}


@pytest.mark.parametrize("seed", [1, 2])
def test_tables_give_what_a_loop_gives(spark, seed):
    rows = drawn(seed)
    assert brute(rows)
    assert found_in(running_spikes(volume_table(spark, rows))) == brute(rows)
    assert found_in(running_spikes(volume_table(spark, rows), factor=2.0)) == brute(rows, 2.0)
    assert running_spikes(volume_table(spark, [])).count() == 0


def one_at_a_time(spark, rows, batches):
    """Spikes of trades that arrive in order, by a query that is started anew for each batch."""
    source, out, progress = shared_path(spark, "in"), shared_path(spark, "out"), shared_path(spark, "progress")
    rows = sorted(rows, key=lambda r: r[1])
    size = -(-len(rows) // batches)
    for i in range(0, len(rows), size):
        part = [(s, 1.0, v, at(60 * m)) for s, m, v in rows[i : i + size]]
        trades(spark, *part).coalesce(1).write.mode("append").parquet(source)
        stream = running_spikes(bars_1min(spark.readStream.schema(TRADE).parquet(source)))
        start_query(
            stream, "parquet", progress, trigger={"availableNow": True}, state_partitions=2, path=out
        ).awaitTermination()
    return spark.read.schema(ANOMALY).parquet(out)


@pytest.mark.parametrize("batches", [1, 4])
def test_streams_carry_the_mean_through_batches_and_restarts(spark, batches):
    rows = drawn(3)
    last = max(m for _, m, _ in rows)
    rows = [r for r in rows if r[1] < last] + [("Z", last + 1, 1.0)]  # what is last stays open
    expected = brute([r for r in rows if r[0] != "Z"])
    assert expected
    assert found_in(one_at_a_time(spark, rows, batches)) == expected


def test_a_spike_in_a_batch_of_one_bar_fires(spark):
    rows = [("A", m, 1.0) for m in range(4)] + [("A", 4, 50.0), ("A", 6, 1.0)]
    assert found_in(one_at_a_time(spark, rows, len(rows))) == {("A", 4, 50.0, 10.8)}


def test_the_flow_writes_them_to_a_table_of_their_own(spark):
    volumes = [1.0] * 6 + [50.0, None, 1.0]
    source = shared_path(spark, "envelopes")
    tables = {
        name: ParquetTable(shared_path(spark, name), schema)
        for name, schema in (("bars", FULL_BAR), ("five", SHORT_BAR), ("anomalies", ANOMALY), ("running", ANOMALY))
    }
    progress = shared_path(spark, "progress")
    for m, volume in enumerate(volumes):
        if volume is None:
            continue
        item = {"p": 1.0, "s": "A", "t": int(at(60 * m).timestamp() * 1000), "v": volume, "c": None}
        spark.createDataFrame([{"type": "trade", "data": [item]}], ENVELOPE).write.mode("append").parquet(source)
        if m < 5:
            continue
        queries = start_flow(
            envelope_files(spark, source), progress, tables["bars"], tables["five"], tables["anomalies"],
            trigger={"availableNow": True}, state_partitions=2, running_anomalies=tables["running"],
        )
        wait_for_all(queries)
    assert tables["bars"].read(spark).count() == 7
    assert found_in(tables["running"].read(spark)) == {("A", 6, 50.0, 8.0)}
    assert tables["anomalies"].read(spark).count() == 0
