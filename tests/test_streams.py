import os
from datetime import timedelta
from pathlib import Path
from unittest.mock import MagicMock

import pytest

from helpers import BASE, at, clock, envelopes, item, trades
from tickloom.operators import bars_1min, bars_5min, first_messages, flatten_trades, volume_spikes
from tickloom.operators.wire import parse_json_messages
from tickloom.plans import start_flow
from tickloom.schema import ANOMALY, FULL_BAR, SHORT_BAR, TRADE
from tickloom.session import STREAM_SETTINGS, shared_path
from tickloom.sinks import REJECT_KEY, Appended, ParquetTable, lake_stream, reject_schema
from tickloom.sources import envelope_files, kafka_stream, kafka_topic, read_lake
from tickloom.streaming import (
    append_batches,
    start_query,
    wait_for_all,
    wait_for_any,
    write_bars_and_spikes,
)

ONCE = {"availableNow": True}


def read_all(batch, batch_id):
    batch.count()


class Arrivals:
    """A folder that files of trades arrive in, one after the other."""

    def __init__(self, spark):
        self.spark, self.path, self.files = spark, shared_path(spark, "arrivals"), 0
        self.folder = Path(self.path.removeprefix("file:"))

    def add(self, *rows):
        before = set(self.folder.glob("*.parquet"))
        trades(self.spark, *rows).coalesce(1).write.mode("append").parquet(self.path)
        [new] = set(self.folder.glob("*.parquet")) - before
        self.files += 1
        os.utime(new, (1_700_000_000 + self.files, 1_700_000_000 + self.files))

    def stream(self):
        reader = self.spark.readStream.schema(TRADE).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.path)


def run(df, sink, checkpoint, **options):
    query = start_query(df, sink, checkpoint, trigger=ONCE, state_partitions=2, **options)
    wait_for_all([query])
    return query


def test_late_rows_and_withheld_windows(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 10.0, at(5)), ("A", 1.0, 5.0, at(50)))
    arrivals.add(("A", 1.0, 1.0, at(71)))
    arrivals.add(("A", 1.0, 5.0, at(55)), ("A", 1.0, 2.0, at(80)))
    arrivals.add(("A", 1.0, 3.0, at(131)))
    seen = []

    def note(batch, batch_id):
        rows = clock(batch, "window_start").collect()
        seen.extend((batch_id, r.window_start, r.total_volume, r.trade_count) for r in rows)

    run(bars_1min(arrivals.stream()), note, shared_path(spark, "progress"))
    # Batch 2 closes 14:30 and still counts the late row that came with it; the last batch,
    # without data, closes 14:31; 14:32 stays open.
    assert seen == [(2, "14:30:00", 20.0, 3), (4, "14:31:00", 3.0, 2)]


def test_rows_for_closed_windows_are_dropped_after_a_restart(spark):
    arrivals, checkpoint = Arrivals(spark), shared_path(spark, "progress")
    table = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    arrivals.add(("A", 1.0, 1.0, at(10)), ("A", 1.0, 2.0, at(100)))
    run(bars_1min(arrivals.stream()), append_batches(table), checkpoint)
    # 14:30 is closed and 14:31 is open, with its volume of 2 in the checkpoint.
    arrivals.add(("A", 1.0, 50.0, at(20)), ("A", 1.0, 4.0, at(70)), ("A", 1.0, 8.0, at(200)))
    run(bars_1min(arrivals.stream()), append_batches(table), checkpoint)
    rows = clock(table.read(spark), "window_start").collect()
    assert sorted((r.window_start, r.total_volume) for r in rows) == [
        ("14:30:00", 1.0),
        ("14:31:00", 6.0),
    ]


def test_sliding_bars_wait_thirty_seconds(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)), ("A", 1.0, 1.0, at(89)))
    seen = []
    run(
        bars_5min(arrivals.stream()),
        lambda batch, _: seen.extend(clock(batch, "window_end").collect()),
        shared_path(spark, "progress"),
    )
    # The watermark is 14:30:59, so no window with the trades has ended by then.
    assert seen == []
    arrivals.add(("A", 1.0, 1.0, at(90)))
    run(
        bars_5min(arrivals.stream()),
        lambda batch, _: seen.extend(clock(batch, "window_end").collect()),
        shared_path(spark, "progress"),
    )
    assert [row.window_end for row in seen] == ["14:31:00"]


def test_spikes_are_judged_per_micro_batch(spark):
    arrivals = Arrivals(spark)
    minutes = [("A", 1.0, v, at(60 * i)) for i, v in enumerate([1.0, 1.0, 1.0, 90.0, 1.0])]
    bars = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    anomalies = ParquetTable(shared_path(spark, "anomalies"), ANOMALY)
    # All five bars close in one batch: the spike shows.
    arrivals.add(*minutes, ("A", 1.0, 1.0, at(600)))
    checkpoint = shared_path(spark, "progress")
    run(bars_1min(arrivals.stream()), write_bars_and_spikes(bars, anomalies), checkpoint)
    assert [r.total_volume for r in anomalies.read(spark).collect()] == [90.0]
    assert bars.read(spark).count() == 5
    # One bar per batch: each is its own mean, so nothing can show.
    later = [("A", 1.0, v, at(600 + 60 * i)) for i, v in enumerate([1.0, 1.0, 1.0, 90.0, 1.0, 1.0])]
    for row in later[1:]:
        arrivals.add(row)
    run(bars_1min(arrivals.stream()), write_bars_and_spikes(bars, anomalies), checkpoint)
    assert bars.read(spark).count() > 5
    assert anomalies.read(spark).count() == 1


def test_a_batch_repeated_after_a_crash_leaves_no_duplicates(spark):
    arrivals, checkpoint = Arrivals(spark), shared_path(spark, "progress")
    bars = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    anomalies = ParquetTable(shared_path(spark, "anomalies"), ANOMALY)
    values = [1.0, 1.0, 1.0, 1.0, 90.0]
    arrivals.add(*[("A", 1.0, v, at(60 * i)) for i, v in enumerate(values)], ("A", 1.0, 1.0, at(900)))
    write, crashes = write_bars_and_spikes(bars, anomalies), []

    def crash_after_writing(batch, batch_id):
        write(batch, batch_id)
        if not crashes and bars.read(spark).count():
            crashes.append(batch_id)
            raise RuntimeError("lost the driver")

    with pytest.raises(Exception, match="lost the driver"):
        run(bars_1min(arrivals.stream()), crash_after_writing, checkpoint)
    assert bars.read(spark).count() == 5 and crashes
    run(bars_1min(arrivals.stream()), crash_after_writing, checkpoint)
    assert sorted(r.total_volume for r in bars.read(spark).collect()) == values
    assert [r.total_volume for r in anomalies.read(spark).collect()] == [90.0]


def message_folder(spark, *groups):
    path = shared_path(spark, "envelopes")
    for group in groups:
        envelopes(spark, *group).coalesce(1).write.mode("append").parquet(path)
    return path


def test_flow_from_envelopes_to_all_outputs(spark):
    volumes = [2.0, 2.0, 2.0, 2.0, 90.0, 2.0]
    items = [item("A", 10.0 + i, v, at(60 * i)) for i, v in enumerate(volumes)]
    path = message_folder(
        spark,
        [("trade", items), ("ping", []), ("trade", [item("B", 5.0, 1.0, at(720))])],
    )
    tables = {
        "minute_bars": ParquetTable(shared_path(spark, "bars_1min"), FULL_BAR),
        "five_minute_bars": ParquetTable(shared_path(spark, "bars_5min"), SHORT_BAR),
        "anomalies": ParquetTable(shared_path(spark, "anomalies"), ANOMALY),
    }
    lake, checkpoints = shared_path(spark, "lake"), shared_path(spark, "progress")
    for _ in range(2):  # the second run finds nothing new
        queries = start_flow(
            envelope_files(spark, path),
            checkpoints,
            lake=lake,
            trigger=ONCE,
            state_partitions=2,
            **tables,
        )
        assert len(queries) == 3
        wait_for_all(queries)

    flat = flatten_trades(spark.read.parquet(path))
    assert sorted(read_lake(spark, lake).collect()) == sorted(flat.collect())
    # Batch bars of the same trades, without the windows that are still open.
    minute = bars_1min(flat).where("symbol = 'A'")
    assert sorted(tables["minute_bars"].read(spark).collect()) == sorted(minute.collect())
    five = bars_5min(flat).where("window_end <= timestamp '2024-06-01 14:41:30Z'")
    as_rows = lambda df: sorted(
        tuple(round(v, 9) if isinstance(v, float) else str(v) for v in row) for row in df.collect()
    )
    assert as_rows(tables["five_minute_bars"].read(spark)) == as_rows(five)
    found = tables["anomalies"].read(spark).collect()
    assert found == volume_spikes(minute).collect() and [r.total_volume for r in found] == [90.0]


def test_flow_without_lake_runs_two_queries(spark):
    path = message_folder(spark, [("trade", [item("A", 1.0, 1.0, at(0))])])
    queries = start_flow(
        envelope_files(spark, path),
        shared_path(spark, "progress"),
        ParquetTable(shared_path(spark, "a"), FULL_BAR),
        ParquetTable(shared_path(spark, "b"), SHORT_BAR),
        ParquetTable(shared_path(spark, "c"), ANOMALY),
        trigger=ONCE,
        state_partitions=2,
    )
    wait_for_all(queries)
    assert len(queries) == 2 and all(q.exception() is None for q in queries)


def test_flow_from_messages(spark):
    """Parse, flatten and aggregate in one streaming plan."""
    path = shared_path(spark, "messages")
    data = [item("A", 10.0, 2.0, at(5)), item("A", 20.0, 2.0, at(130))]
    envelopes(spark, ("trade", data)).selectExpr("to_json(struct(*)) AS value").write.parquet(path)
    stream = spark.readStream.schema("value string").parquet(path)
    seen = []
    run(
        bars_1min(flatten_trades(parse_json_messages(stream))),
        lambda batch, _: seen.extend(batch.collect()),
        shared_path(spark, "progress"),
    )
    assert [(r.symbol, r.total_volume, r.avg_price) for r in seen] == [("A", 2.0, 10.0)]


def test_lake_stream_writes_by_hour(spark):
    arrivals, lake = Arrivals(spark), shared_path(spark, "lake")
    arrivals.add(("A", 1.0, 1.0, at(0)), ("B", 2.0, 1.0, at(3600)))
    arrivals.add(("C", 3.0, 1.0, at(1)))
    query = start_query(
        lake_stream(arrivals.stream(), lake), checkpoint=shared_path(spark, "progress"), trigger=ONCE
    )
    wait_for_all([query])
    assert sorted(row.symbol for row in read_lake(spark, lake).collect()) == ["A", "B", "C"]
    folder = Path(lake.removeprefix("file:")) / "year=2024" / "month=6" / "day=1"
    assert sorted(f.name for f in folder.iterdir()) == ["hour=14", "hour=15"]


def test_console_query(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)))
    query = start_query(arrivals.stream(), checkpoint=shared_path(spark, "progress"), trigger=ONCE, truncate=False)
    wait_for_all([query])
    assert query.exception() is None and query.recentProgress[0].numInputRows == 1


def test_modes_and_names(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)), ("A", 1.0, 2.0, at(100)))
    seen = []
    query = start_query(
        bars_1min(arrivals.stream()),
        lambda batch, _: seen.extend(batch.collect()),
        shared_path(spark, "progress"),
        mode="update",
        trigger=ONCE,
        state_partitions=2,
        name="open_bars",
    )
    wait_for_all([query])
    assert query.name == "open_bars"
    assert sorted(row.total_volume for row in seen) == [1.0, 2.0]  # open windows too


def test_state_is_kept_in_rocksdb_and_settings_are_restored(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)), ("A", 1.0, 2.0, at(100)))
    before = {key: spark.conf.get(key, None) for key in STREAM_SETTINGS}
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    query = run(bars_1min(arrivals.stream()), read_all, shared_path(spark, "progress"))
    state = query.recentProgress[0].stateOperators[0]
    assert any("rocksdb" in name for name in state.customMetrics)
    assert state.numShufflePartitions == 2
    assert {key: spark.conf.get(key, None) for key in STREAM_SETTINGS} == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions


def test_files_per_batch_can_be_bounded(spark):
    one = [("trade", [item("A", 1.0, 1.0, at(0))])]
    path = message_folder(spark, one, one, one)
    query = run(
        envelope_files(spark, path, max_files=1), read_all, shared_path(spark, "progress")
    )
    assert [p.numInputRows for p in query.recentProgress] == [1, 1, 1]


def test_json_files_are_a_source_too(spark):
    path = shared_path(spark, "json")
    envelopes(spark, ("trade", [item("A", 1.5, 1.0, at(0))])).write.json(path)
    seen = []
    run(
        flatten_trades(envelope_files(spark, path, format="json")),
        lambda batch, _: seen.extend(batch.collect()),
        shared_path(spark, "progress"),
    )
    assert [row.price for row in seen] == [1.5]


def test_first_messages_of_a_stream(spark):
    one = [("trade", [item("A", 1.0, 1.0, at(0))])]
    path = message_folder(spark, one, one, one)
    seen = []
    run(
        first_messages(envelope_files(spark, path, max_files=1), 2),
        lambda batch, _: seen.extend(batch.collect()),
        shared_path(spark, "progress"),
    )
    assert len(seen) == 2


def failing(batch, batch_id):
    raise RuntimeError("sink is gone")


def test_waiting_for_any_stops_the_rest_of_the_flow_only(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)))
    foreign = start_query(arrivals.stream(), lambda *_: None, shared_path(spark, "progress"))
    steady = start_query(arrivals.stream(), lambda *_: None, shared_path(spark, "progress"))
    broken = start_query(arrivals.stream(), failing, shared_path(spark, "progress"))
    try:
        with pytest.raises(Exception, match="sink is gone"):
            wait_for_any([steady, broken])
        assert not steady.isActive and foreign.isActive
    finally:
        foreign.stop()


def test_waiting_for_all_sees_a_failure_behind_a_running_query(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)))
    steady = start_query(arrivals.stream(), lambda *_: None, shared_path(spark, "progress"))
    broken = start_query(arrivals.stream(), failing, shared_path(spark, "progress"))
    with pytest.raises(Exception, match="sink is gone"):
        wait_for_all([steady, broken])
    assert not steady.isActive


def test_queries_need_a_checkpoint_and_writers_keep_their_sink(spark):
    arrivals = Arrivals(spark)
    arrivals.add(("A", 1.0, 1.0, at(0)))
    with pytest.raises(ValueError, match="checkpoint"):
        start_query(arrivals.stream(), "parquet", path=shared_path(spark, "x"))
    writer = lake_stream(arrivals.stream(), shared_path(spark, "lake"))
    for given in ({"sink": "console"}, {"mode": "update"}):
        with pytest.raises(ValueError, match="own sink and mode"):
            start_query(writer, checkpoint=shared_path(spark, "progress"), **given)


def test_an_empty_batch_ends_before_the_spikes(spark, monkeypatch):
    looked = []
    monkeypatch.setattr("tickloom.streaming.batches.volume_spikes", lambda *a: looked.append(a))
    bars = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    anomalies = ParquetTable(shared_path(spark, "anomalies"), ANOMALY)
    empty = bars_1min(trades(spark, ("A", 1.0, 1.0, None)))
    for table in (bars, None):
        write_bars_and_spikes(table, anomalies)(empty, 0)
    assert not looked


def test_batches_are_reported(spark):
    heard = []
    bars = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    anomalies = ParquetTable(shared_path(spark, "anomalies"), ANOMALY)
    rows = [("A", 1.0, v, at(60 * i)) for i, v in enumerate([1.0, 1.0, 1.0, 90.0])]
    write = write_bars_and_spikes(bars, anomalies, salts=2, report=lambda *said: heard.append(said))
    write(bars_1min(trades(spark, *rows)), 7)
    assert heard == [(7, "bars", Appended(4, 4)), (7, "anomalies", Appended(1, 1))]


def test_a_trade_without_symbol_does_not_end_the_flow(spark):
    items = [item(None, 1.0, 1.0, at(0)), item("A", 1.0, 1.0, at(1)), item("A", 1.0, 1.0, at(700))]
    path = message_folder(spark, [("trade", items)])
    tables = {name: ParquetTable(shared_path(spark, name), FULL_BAR) for name in ("minute_bars",)}
    tables["five_minute_bars"] = ParquetTable(shared_path(spark, "five"), SHORT_BAR)
    tables["anomalies"] = ParquetTable(shared_path(spark, "anomalies"), ANOMALY)
    for name, schema in (("minute_rejects", FULL_BAR), ("five_minute_rejects", SHORT_BAR)):
        tables[name] = ParquetTable(shared_path(spark, name), reject_schema(schema), REJECT_KEY)
    queries = start_flow(
        envelope_files(spark, path), shared_path(spark, "progress"), trigger=ONCE, state_partitions=2, **tables
    )
    wait_for_all(queries)
    assert [r.symbol for r in tables["minute_bars"].read(spark).collect()] == ["A"]
    assert [r.problems for r in tables["minute_rejects"].read(spark).collect()] == ["symbol missing"]
    assert tables["five_minute_rejects"].read(spark).count() == 5


# Kafka: the connector is not installed here, so only what Spark is asked for is checked.


def test_kafka_stream_options():
    session = MagicMock()
    kafka_stream(session, "host:9092", "ticks", max_offsets=500, min_partitions=64, failOnDataLoss="false")
    session.readStream.format.assert_called_once_with("kafka")
    first = session.readStream.format.return_value.options
    first.assert_called_once_with(
        **{"kafka.bootstrap.servers": "host:9092", "subscribe": "ticks", "startingOffsets": "latest"}
    )
    bounded = first.return_value.option
    bounded.assert_called_once_with("maxOffsetsPerTrigger", 500)
    bounded.return_value.option.assert_called_once_with("minPartitions", 64)


def test_kafka_topic_reads_from_the_start_by_default():
    session = MagicMock()
    kafka_topic(session, "host:9092", "ticks")
    session.read.format.assert_called_once_with("kafka")
    session.read.format.return_value.options.assert_called_once_with(
        **{
            "kafka.bootstrap.servers": "host:9092",
            "subscribe": "ticks",
            "startingOffsets": "earliest",
            "endingOffsets": "latest",
        }
    )


def test_base_is_utc():
    assert BASE.utcoffset() == timedelta(0)
