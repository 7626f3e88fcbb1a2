"""Writing trades to the lake: Snappy Parquet, one folder per hour of event time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions import hour_parts
from tickloom.session import path_exists, remove_path, settings, shared_path
from tickloom.sinks.tables import symbol_filter
from tickloom.sources.lake import LAKE, PARTS, read_lake


def append_to_lake(trades: DataFrame, path: str) -> None:
    """Append a table of trades.

    The rebalance gives each hour few files of the advisory size and splits a crowded hour
    over many tasks. The sort serves the writer, which wants rows by folder, and lets
    readers skip row groups by symbol and time.
    """
    rows = trades.withColumns(hour_parts("event_time"))
    (
        rows.hint("rebalance", *[F.col(part) for part in PARTS])
        .sortWithinPartitions(*PARTS, "symbol", "event_time")
        .write.mode("append")
        .option("compression", "snappy")
        .options(**symbol_filter(LAKE))
        .partitionBy(*PARTS)
        .parquet(path)
    )


def lake_stream(trades: DataFrame, path: str) -> DataStreamWriter:
    """A file sink for a stream of trades, exactly once through the sink's own commit log.

    Rows are not shuffled by hour: live trades nearly all fall into the same one. A lake
    folder should have either streams or append_to_lake as writers, because readers of a
    folder with a commit log see only what the log lists. That log names every file ever written
    and the driver reads it; for a long-lived lake, start a new folder from time to time.
    """
    return (
        trades.withColumns(hour_parts("event_time"))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("compression", "snappy")
        .option("path", path)
        .options(**symbol_filter(LAKE))
        .partitionBy(*PARTS)
    )


def compact_lake(spark: SparkSession, path: str, start: datetime, end: datetime) -> None:
    """Rewrite the hours from start up to end (both full hours, UTC) into few files each.

    Meant for hours that no writer appends to any more. The rows go to the shared folder first, so
    that the lake holds either the old or the new files of an hour while its folder is replaced.
    """
    if any((m.minute, m.second, m.microsecond) != (0, 0, 0) for m in (start, end)):
        raise ValueError("start and end must be full hours")
    if path_exists(spark, f"{path}/_spark_metadata"):
        raise ValueError("a stream's commit log lists the files of this lake")
    staging = shared_path(spark, "compaction")
    append_to_lake(read_lake(spark, path, start, end), staging)
    if not path_exists(spark, staging):
        return
    with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        rows = spark.read.schema(LAKE).parquet(staging)
        (
            rows.hint("rebalance", *[F.col(part) for part in PARTS])
            .sortWithinPartitions(*PARTS, "symbol", "event_time")
            .write.mode("overwrite")
            .option("compression", "snappy")
            .options(**symbol_filter(LAKE))
            .partitionBy(*PARTS)
            .parquet(path)
        )
    remove_path(spark, staging)
