"""Stored tables that bars and anomalies are appended to and read back from.

A table has a unique key and a time column. It offers append(df, rows), where `rows` is the
size of df if known; between(spark, low, high), the stored rows in a range of the time column; and
latest(spark, order, n). Bounds are microseconds since the epoch, so they do not depend on the
session's time zone.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import utc_day
from tickloom.session import hadoop_path, path_exists, remove_path, settings, shared_path

# The unique key of the stored bars; anomalies share it.
KEY = ("window_start", "symbol")

# Up to so many folders are looked for one by one; beyond that, the table is listed.
FOLDERS_NAMED = 8

DAY_MICROS = 86_400_000_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def _in_range(df: DataFrame, time: str, low: int, high: int) -> DataFrame:
    return df.where(F.col(time).between(F.timestamp_micros(F.lit(low)), F.timestamp_micros(F.lit(high))))


def day_number(text: str) -> int | None:
    """Days since the epoch of a date as Spark writes it, beyond the years of Python's dates too; None
    for any other text."""
    found = re.fullmatch(r"([+-]?\d{1,7})-(\d\d)-(\d\d)", text)
    if not found:
        return None
    year, month, day = map(int, found.groups())
    turns, inside = divmod(year - 1, 400)  # the calendar repeats after 400 years
    return date(inside + 1, month, day).toordinal() + turns * 146_097 - EPOCH.toordinal()


def symbol_filter(schema: T.StructType) -> dict[str, str]:
    """Parquet options for rows that are looked up by symbol: a bloom filter where a row group has
    too many symbols for a dictionary, no larger than its symbols need."""
    if "symbol" not in schema.names:
        return {}
    return {"parquet.bloom.filter.enabled#symbol": "true", "parquet.bloom.filter.adaptive.enabled": "true"}


def _text(micros: int) -> str:
    return (EPOCH + timedelta(microseconds=micros)).isoformat()


@dataclass(frozen=True)
class JdbcTable:
    """A database table. `connections` bounds the tasks that talk to the database at once, and
    none of them is opened for fewer than `rows_per_connection` rows."""

    url: str
    name: str
    properties: Mapping[str, str] = field(default_factory=dict)
    key: tuple[str, ...] = KEY
    time: str = "window_start"
    connections: int = 16
    rows_per_connection: int = 10_000

    def append(self, df: DataFrame, rows: int | None = None) -> None:
        tasks = self.connections
        if rows is not None:
            tasks = min(tasks, 1 + rows // self.rows_per_connection)
        (
            df.repartition(tasks)
            .write.format("jdbc")
            .options(url=self.url, dbtable=self.name, batchsize="10000", **self.properties)
            .mode("append")
            .save()
        )

    def latest(self, spark: SparkSession, order: str, n: int) -> DataFrame:
        """The first n rows in an SQL order, such as "window_start DESC, symbol".

        The database sorts and cuts, through its index, and hands over n rows; from a
        plain scan Spark would fetch the whole table first.
        """
        text = f"SELECT * FROM {self.name} ORDER BY {order} FETCH FIRST {n} ROWS ONLY"
        return (
            spark.read.format("jdbc").options(url=self.url, query=text, **self.properties).load()
        )

    def read(self, spark: SparkSession) -> DataFrame:
        return (
            spark.read.format("jdbc")
            .options(url=self.url, dbtable=self.name, fetchsize="10000", **self.properties)
            .load()
        )

    def without_time(self, spark: SparkSession) -> DataFrame:
        """The rows whose time is NULL, which between() cannot find."""
        return self.read(spark).where(F.col(self.time).isNull())

    def between(self, spark: SparkSession, low: int, high: int) -> DataFrame:
        """Read in `connections` slices of time; the database applies the range itself."""
        rows = (
            spark.read.format("jdbc")
            .options(url=self.url, dbtable=self.name, fetchsize="10000", **self.properties)
            .options(
                partitionColumn=self.time,
                lowerBound=_text(low),
                upperBound=_text(high),
                numPartitions=self.connections,
            )
            .load()
        )
        return _in_range(rows, self.time, low, high)


@dataclass(frozen=True)
class ParquetTable:
    """A Parquet folder with one partition per UTC day of the time column."""

    path: str
    schema: T.StructType
    key: tuple[str, ...] = KEY
    time: str = "window_start"
    rows_per_file: int = 1_000_000

    def append(self, df: DataFrame, rows: int | None = None) -> None:
        """Few files per day, a crowded day split over many tasks.

        With a known size a hash partitioning does that, also in micro-batches, which run
        without AQE. It needs no sample of its input, as one by range would, which would compute
        the rows twice. Otherwise AQE rebalances.
        """
        dated = df.select(*self.schema.names).withColumn("on_day", utc_day(self.time))
        if rows is None:
            dated = dated.hint("rebalance", F.col("on_day"))
        else:
            dated = dated.repartition(1 + rows // self.rows_per_file, "on_day", *self.key)
        dated.sortWithinPartitions(*self._order()).write.mode("append").options(
            **symbol_filter(self.schema)
        ).partitionBy("on_day").parquet(self.path)

    def _order(self) -> list[str]:
        """The writer sorts by day anyway; within it, readers skip by symbol and time."""
        return ["on_day", *(["symbol"] if "symbol" in self.schema.names else []), self.time]

    def _partitions(self) -> list[T.StructField]:
        return [T.StructField("on_day", T.DateType())]

    def _scan(self, spark: SparkSession, folders: list[str] | None = None) -> DataFrame:
        """All rows, or those in some folders, which must exist, without listing the others."""
        stored = T.StructType([*self.schema.fields, *self._partitions()])
        if folders is None:
            folders = [self.path] if path_exists(spark, self.path) else []
        if not folders:
            return spark.createDataFrame([], stored)
        return spark.read.schema(stored).option("basePath", self.path).parquet(*folders)

    def _folder(self, day: str | date | None) -> str:
        """Of a day, as a date or as Spark writes it; None stands for rows without a time."""
        return f"{self.path}/on_day={'__HIVE_DEFAULT_PARTITION__' if day is None else day}"

    def read(self, spark: SparkSession) -> DataFrame:
        return self._scan(spark).select(*self.schema.names)

    def without_time(self, spark: SparkSession) -> DataFrame:
        """The rows whose time is NULL, which between() cannot find."""
        return self._of_days(spark, [None])

    def _of_days(self, spark: SparkSession, days: Collection[str | None]) -> DataFrame:
        """The rows of some days: a call for each of a few, else one listing of the table's folders."""
        folders = [self._folder(day) for day in days]
        if len(folders) <= FOLDERS_NAMED:
            found = [f for f in folders if path_exists(spark, f)]
        else:
            held = {f"{self.path}/{name}" for name in self._names(spark)}
            found = [f for f in folders if f in held]
        return self._scan(spark, found).select(*self.schema.names)

    def near(self, spark: SparkSession, days: Collection[str | None], low: int, high: int) -> DataFrame:
        """The rows of the given days (as texts) and in a time range: one odd time among the days
        costs one folder, not all those between."""
        return _in_range(self._of_days(spark, days), self.time, low, high)

    def between(self, spark: SparkSession, low: int, high: int) -> DataFrame:
        """Only the days concerned are read, and a long range is compared with those that exist."""
        first, last = low // DAY_MICROS, high // DAY_MICROS
        days = [day for number, day in self._numbered_days(spark) if first <= number <= last]
        return self.near(spark, days, low, high)

    def _names(self, spark: SparkSession) -> list[str]:
        """The folders of days; one listing of folders, none of files."""
        if not path_exists(spark, self.path):
            return []
        folder, files = hadoop_path(spark, self.path)
        names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
        return [name for name in names if name.startswith("on_day=")]

    def _numbered_days(self, spark: SparkSession) -> list[tuple[int, str]]:
        """(day number, day as Spark writes it) of all days with a folder, in order."""
        days = [name.removeprefix("on_day=") for name in self._names(spark)]
        return sorted((number, day) for day in days if (number := day_number(day)) is not None)

    def days(self, spark: SparkSession) -> list[date]:
        """The days with a folder, in order, as far as Python's dates reach."""
        bounds = [(d - EPOCH.date()).days for d in (date.min, date.max)]
        return [
            EPOCH.date() + timedelta(days=number)
            for number, _ in self._numbered_days(spark)
            if bounds[0] <= number <= bounds[1]
        ]

    def latest(self, spark: SparkSession, order: str, n: int) -> DataFrame:
        """The first n rows in an SQL order, such as "window_start DESC, symbol".

        If the order begins with the time column descending, the newest days are counted, twice
        as many in each job as in the one before, until they hold n rows, and only those needed are read;
        rows without a time come last. Any other order is a top-k scan of the table.
        """
        terms = [F.expr(column).desc() if down else F.expr(column) for column, down in _ordering(order)]
        first, down = _ordering(order)[0]
        rows = self._scan(spark)
        if first == self.time and down:
            days = [day for _, day in reversed(self._numbered_days(spark))]
            held, taken, step = 0, 0, 1
            while taken < len(days) and held < n:
                some = days[taken : taken + step]
                counted = self._scan(spark, [self._folder(day) for day in some]).groupBy(F.col("on_day").cast("string")).count()
                rows_of = dict(counted.collect())
                for day in some:
                    if held < n:
                        held, taken = held + rows_of.get(day, 0), taken + 1
                step *= 2
            rows = self._of_days(spark, [*days[:taken], *([None] if held < n else [])])
        return rows.select(*self.schema.names).orderBy(*terms).limit(n)

    def compact(self, spark: SparkSession, first: date, last: date) -> None:
        """Rewrite the days from first to last into few files each.

        Every append adds a file per day, so a day that streams have written holds thousands of
        small ones. Meant for days that no writer appends to any more. The rows go to the shared
        folder first; then each day's folder is replaced.
        """
        days = [d for d in self.days(spark) if first <= d <= last]
        if not days:
            return
        staging = ParquetTable(shared_path(spark, "compaction"), self.schema, self.key, self.time)
        rows = self._scan(spark, [self._folder(day) for day in days]).select(*self.schema.names)
        staging.append(rows)
        with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            dated = staging.read(spark).withColumn("on_day", utc_day(self.time))
            (
                dated.hint("rebalance", F.col("on_day"))
                .sortWithinPartitions(*self._order())
                .write.mode("overwrite")
                .options(**symbol_filter(self.schema))
                .partitionBy("on_day")
                .parquet(self.path)
            )
        remove_path(spark, staging.path)


def _ordering(order: str) -> list[tuple[str, bool]]:
    """Columns of an SQL order and whether they descend."""
    found = []
    for term in order.split(","):
        column, *side = term.split()
        found.append((column, [s.upper() for s in side] == ["DESC"]))
    return found
