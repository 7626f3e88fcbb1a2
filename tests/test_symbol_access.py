"""Reading few symbols of large files: pages and row groups of others are skipped."""

from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from helpers import BASE
from tickloom.schema import FULL_BAR
from tickloom.session import shared_path
from tickloom.sinks import ParquetTable, append_to_lake, compact_lake
from tickloom.sources import read_lake

ROWS = 200_000


@pytest.fixture
def small_groups(spark):
    """Row groups of some 20,000 rows instead of a whole file."""
    settings = spark.sparkContext._jsc.hadoopConfiguration()
    settings.set("parquet.block.size", str(256 * 1024))
    yield
    settings.unset("parquet.block.size")


def many_trades(spark, symbol):
    moment = F.timestamp_micros(F.lit(int(BASE.timestamp() * 1e6)) + F.col("id"))
    return spark.range(ROWS).select(
        symbol.alias("symbol"), F.rand(1).alias("price"), F.rand(2).alias("volume"), moment.alias("event_time")
    )


def scanned(df):
    """How many rows of the files the scan of a query has read; the query is run."""
    kept = df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return len(kept), leaf.metrics().apply("numOutputRows").value()


def test_symbols_are_read_without_the_others(spark, small_groups):
    path = shared_path(spark, "lake")
    append_to_lake(many_trades(spark, F.concat(F.lit("S"), F.col("id") % 50)), path)
    start, end = BASE - timedelta(minutes=30), BASE + timedelta(minutes=30)
    for _ in range(2):
        assert scanned(read_lake(spark, path, start, end)) == (ROWS, ROWS)
        kept, read = scanned(read_lake(spark, path, start, end, symbols=["S7"]))
        assert kept == ROWS // 50 and read < ROWS / 4
        assert scanned(read_lake(spark, path, symbols=["S7x"])) == (0, 0)
        compact_lake(spark, path, start, end)
    both = read_lake(spark, path, symbols=["S1", "S49"])
    assert {r.symbol for r in both.select("symbol").distinct().collect()} == {"S1", "S49"}
    assert both.count() == 2 * ROWS // 50
    assert read_lake(spark, path, symbols=[]).count() == 0


def test_symbols_too_many_for_a_dictionary_have_a_bloom_filter(spark, small_groups):
    """Symbols are as many as rows, so only a bloom filter can tell that one between is absent."""
    path = shared_path(spark, "lake")
    append_to_lake(many_trades(spark, F.sha2(F.col("id").cast("string"), 256)), path)
    present = spark.range(1).select(F.sha2(F.lit("77"), 256)).first()[0]
    kept, read = scanned(read_lake(spark, path, symbols=[present]))
    assert kept == 1 and read < ROWS / 4
    absent = [spark.range(1).select(F.sha2(F.lit(f"x{i}"), 256)).first()[0] for i in range(5)]
    assert sum(scanned(read_lake(spark, path, symbols=[s]))[1] for s in absent) == 0


def test_stored_bars_are_read_by_symbol(spark, small_groups):
    start = F.timestamp_micros(F.lit(int(BASE.timestamp() * 1e6)) + F.col("id"))
    number = F.col("id").cast("double")
    measures = [F.lit(1).cast("long").alias(f.name) if f.name == "trade_count" else number.alias(f.name) for f in FULL_BAR.fields[3:]]
    bars = spark.range(ROWS).select(
        start.alias("window_start"), start.alias("window_end"), F.concat(F.lit("S"), F.col("id") % 50).alias("symbol"), *measures
    )
    table = ParquetTable(shared_path(spark, "bars"), FULL_BAR)
    table.append(bars, ROWS)
    kept, read = scanned(table.read(spark).where("symbol = 'S7'"))
    assert kept == ROWS // 50 and read < ROWS / 4
