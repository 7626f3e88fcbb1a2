import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from helpers import BASE, at, plan_of, trades, volume_bars
from tickloom.operators import mean_volumes, recent_anomalies, recent_bars, volume_spikes
from tickloom.plans import spikes_of_trades
from tickloom.schema import ANOMALY, FULL_BAR
from tickloom.session import settings, store


@pytest.mark.parametrize("salts", [1, 8])
@pytest.mark.parametrize(
    "volumes, expected",
    [
        ([1, 1, 1000], []),
        ([1, 1, 1, 1000], [(1000.0, 250.75, 1000 / 250.75)]),
        ([0, 0, 0, 3, 1, 2], []),  # exactly three times the mean is no spike
        ([0, 0, 0, 0], []),
        ([5], []),
    ],
)
def test_bounds(spark, volumes, expected, salts):
    found = volume_spikes(volume_bars(spark, "A", volumes), salts=salts).collect()
    assert [(row.total_volume, row.avg_volume, row.ratio) for row in found] == expected


def test_schema(spark):
    found = volume_spikes(volume_bars(spark, "A", [1]))
    assert [(f.name, f.dataType) for f in found.schema] == [(f.name, f.dataType) for f in ANOMALY]


def test_means_are_per_symbol(spark):
    quiet = volume_bars(spark, "QUIET", [1, 1, 1, 1, 10])
    busy = volume_bars(spark, "BUSY", [100, 100, 100, 100, 110])
    table = quiet.unionByName(busy)
    assert [row.symbol for row in volume_spikes(table).collect()] == ["QUIET"]
    means = {row.symbol: row.avg_volume for row in mean_volumes(table).collect()}
    assert means == {"QUIET": 2.8, "BUSY": 102.0}


def test_factor_is_a_parameter(spark):
    table = volume_bars(spark, "A", [1, 1, 1, 3])
    assert volume_spikes(table).count() == 0
    assert volume_spikes(table, factor=1.5).count() == 1


def test_bars_without_symbol_or_volume_are_no_spikes(spark):
    assert volume_spikes(volume_bars(spark, None, [1, 1, 1, 1000])).count() == 0
    nameless = volume_bars(spark, "A", [1, 1]).withColumn("total_volume", F.lit(None).cast("double"))
    assert volume_spikes(nameless).count() == 0


def random_bars(spark, seed):
    draw = random.Random(seed)
    table, volumes = None, {}
    for symbol, bars in (("HOT", 900), ("A", 300), ("B", 250), ("C", 2)):
        volumes[symbol] = [draw.choice([1, 2, 3, 40]) for _ in range(bars)]
        part = volume_bars(spark, symbol, volumes[symbol])
        table = part if table is None else table.unionByName(part)
    return table, volumes


@pytest.mark.parametrize("broadcast", ["10MB", "-1"])
@pytest.mark.parametrize("salts", [1, 16])
def test_against_brute_force_with_a_hot_symbol(spark, salts, broadcast):
    table, volumes = random_bars(spark, 3)
    expected = defaultdict(int)
    for symbol, values in volumes.items():
        mean = sum(values) / len(values)
        expected[symbol] += sum(v > 3 * mean for v in values)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": broadcast}):
        found = volume_spikes(store(table, "bars"), salts=salts)
        counts = {row.symbol: row["count"] for row in found.groupBy("symbol").count().collect()}
    assert counts == {symbol: n for symbol, n in expected.items() if n}


SHUFFLED = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


def test_the_means_are_a_partial_aggregate_and_a_join(spark):
    plan = plan_of(volume_spikes(store(random_bars(spark, 4)[0], "bars")))
    assert "partial_avg" in plan and "BroadcastHashJoin" in plan
    assert "Window" not in plan and "Cartesian" not in plan


def test_a_busy_symbol_is_spread_where_aqe_is_off(spark):
    stored = store(random_bars(spark, 4)[0], "bars")
    with settings(spark, SHUFFLED | {"spark.sql.adaptive.enabled": "false"}):
        for salts, fewest, most in ((32, 3, 4), (1, 1, 1)):
            hot = volume_spikes(stored, salts=salts).where("symbol = 'HOT'")
            parts = hot.select(F.spark_partition_id()).distinct().count()
            assert fewest <= parts <= most


def test_aqe_splits_a_busy_part_further(spark):
    copies = F.explode(F.sequence(F.lit(1), F.lit(200)))
    stored = store(random_bars(spark, 5)[0].withColumn("copy", copies), "bars")
    tiny = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.files.maxPartitionBytes": "64KB",
    }
    with settings(spark, SHUFFLED | tiny):
        found = volume_spikes(stored, salts=2)
        found.collect()
        assert "skew=true" in plan_of(found)


def test_spikes_of_trades_reads_the_trades_once(spark):
    ticks = trades(spark, *[("A", 1.0, v, at(60 * i)) for i, v in enumerate([1.0, 1.0, 1.0, 99.0])])
    found = spikes_of_trades(ticks)
    assert [row.total_volume for row in found.collect()] == [99.0]
    assert "FileScan parquet" in plan_of(found) and "window_start" in plan_of(found)


def test_recent_bars_order_ties_and_limit(spark):
    table = volume_bars(spark, "A", range(30)).unionByName(volume_bars(spark, "B", range(30)))
    rows = recent_bars(table).collect()
    assert len(rows) == 20
    assert [row.symbol for row in rows[:4]] == ["A", "B", "A", "B"]
    assert rows == sorted(rows, key=lambda row: (-row.window_start.timestamp(), row.symbol))
    assert recent_bars(table).columns == [
        "window_start", "symbol", "avg_price", "vwap", "trade_count",
    ]
    assert "TakeOrderedAndProject(limit=20" in plan_of(recent_bars(table))


def test_recent_anomalies(spark):
    table = volume_spikes(volume_bars(spark, "A", [1, 1, 1, 1, 50, 1, 1, 1, 60]))
    stamped = table.withColumn("detected_at", F.col("window_end"))
    assert [row.total_volume for row in recent_anomalies(stamped).collect()] == [60.0, 50.0]
    assert [row.total_volume for row in recent_anomalies(stamped, 1).collect()] == [60.0]
    assert "TakeOrderedAndProject(limit=50" in plan_of(recent_anomalies(stamped))


def test_fixture_bars_match_the_schema(spark):
    assert volume_bars(spark, "A", [1], BASE).schema == FULL_BAR
