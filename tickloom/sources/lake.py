"""Reading the hour-partitioned trade lake."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schema import TRADE
from tickloom.session import hadoop_path, path_exists

PARTS = ("year", "month", "day", "hour")
LAKE = T.StructType([*TRADE.fields, *[T.StructField(n, T.IntegerType()) for n in PARTS]])
HOUR = timedelta(hours=1)
# Up to this length a range names hour folders, beyond it day folders.
_HOURS_NAMED = 48
# Up to so many days are looked for one by one.
_FOLDERS_NAMED = 16


def read_lake(
    spark: SparkSession,
    path: str,
    start: datetime | None = None,
    end: datetime | None = None,
    symbols: Sequence[str] | None = None,
) -> DataFrame:
    """Trades with start <= event_time < end (UTC), reading only the hours concerned.

    With `symbols`, only their trades; files and row groups without them, and the pages of others
    in a sorted file, are skipped by their statistics, dictionaries or bloom filters.

    Spark cannot derive partition filters from event_time, so the range is also put on the
    partition columns. A range with both ends lists the folders of its days or hours only, not the
    lake. A lake that a stream writes is listed through the sink's log instead, because only the
    log tells which files are committed.
    """
    start, end = (moment and _utc(moment) for moment in (start, end))
    if start is not None and end is not None and start >= end:
        return spark.createDataFrame([], TRADE)
    reader = spark.read.schema(LAKE)
    if start is not None and end is not None and not path_exists(spark, f"{path}/_spark_metadata"):
        folders = _existing(spark, path, start, end)
        if not folders:
            return spark.createDataFrame([], TRADE)
        trades = reader.option("basePath", path).parquet(*folders)
    else:
        trades = reader.parquet(path)
    if start is not None:
        trades = trades.where(_from_hour(start, ">") & (F.col("event_time") >= _instant(start)))
    if end is not None:
        trades = trades.where(_from_hour(end, "<") & (F.col("event_time") < _instant(end)))
    if symbols is not None:
        trades = trades.where(F.col("symbol").isin(*symbols))
    return trades.select(*TRADE.names)


def lake_folders(path: str, start: datetime, end: datetime) -> list[str]:
    """The folders that hold a range: of its hours if it is short, else of its days."""
    first = start.replace(minute=0, second=0, microsecond=0)
    if end - first <= _HOURS_NAMED * HOUR:
        hours = [first + i * HOUR for i in range(-(-(end - first) // HOUR))]
        return [f"{path}/year={h.year}/month={h.month}/day={h.day}/hour={h.hour}" for h in hours]
    first = first.replace(hour=0)
    days = [first + timedelta(days=i) for i in range(-(-(end - first) // timedelta(days=1)))]
    return [f"{path}/year={d.year}/month={d.month}/day={d.day}" for d in days]


def _existing(spark: SparkSession, path: str, start: datetime, end: datetime) -> list[str]:
    """Those folders of lake_folders() that exist. A few are looked for one by one; beyond, the
    lake's years, and of those in the range the months, and of these the days, are listed."""
    if end - start <= _FOLDERS_NAMED * timedelta(days=1):
        return [f for f in lake_folders(path, start, end) if path_exists(spark, f)]
    bounds = [(m.year, m.month, m.day) for m in (start, end - timedelta(microseconds=1))]
    level: list[tuple[int, ...]] = [()]
    for depth, part in enumerate(PARTS[:3]):
        below = []
        for values in level:
            names = "/".join(f"{p}={v}" for p, v in zip(PARTS, values, strict=False))
            below += [(*values, v) for v in _values(spark, f"{path}/{names}".rstrip("/"), part)]
        level = [v for v in below if bounds[0][: depth + 1] <= v <= bounds[1][: depth + 1]]
    return [f"{path}/year={y}/month={m}/day={d}" for y, m, d in sorted(level)]


def _values(spark: SparkSession, folder: str, part: str) -> list[int]:
    """The values of a partition column below a folder."""
    if not path_exists(spark, folder):
        return []
    found, files = hadoop_path(spark, folder)
    names = [s.getPath().getName() for s in files.listStatus(found) if s.isDirectory()]
    texts = [name.removeprefix(f"{part}=") for name in names if name.startswith(f"{part}=")]
    return [int(text) for text in texts if text.isdigit()]


def _utc(moment: datetime) -> datetime:
    return moment.replace(tzinfo=timezone.utc) if moment.tzinfo is None else moment.astimezone(timezone.utc)


def _from_hour(moment: datetime, side: str) -> Column:
    """Folders from (">") or up to ("<") the hour of a moment, by comparisons on single columns,
    which a catalogue can evaluate too."""
    values = (moment.year, moment.month, moment.day, moment.hour)
    condition = F.col("hour") >= values[3] if side == ">" else F.col("hour") <= values[3]
    for part, value in reversed(list(zip(PARTS[:3], values[:3], strict=True))):
        beyond = F.col(part) > value if side == ">" else F.col(part) < value
        condition = beyond | ((F.col(part) == value) & condition)
    return condition


def _instant(moment: datetime) -> Column:
    return F.lit(moment.isoformat()).cast("timestamp")
