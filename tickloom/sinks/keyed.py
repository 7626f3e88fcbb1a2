"""Replay-safe appends to tables with a unique key."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from tickloom.functions import utc_day
from tickloom.operators.quality import require_columns, split_checked
from tickloom.sinks.tables import JdbcTable, ParquetTable

# The columns of bars and anomalies that must be set.
REQUIRED = ("window_start", "window_end", "symbol")

REJECT_KEY = ("reject_key",)
CONFLICT = "key stored with other values"


@dataclass(frozen=True)
class Appended:
    """What one append did: rows of the batch, and of these the written, the already stored with
    the same values, the ones in conflict with a stored row or each other, and the flawed."""

    rows: int = 0
    written: int = 0
    repeated: int = 0
    conflicts: int = 0
    flawed: int = 0


def reject_schema(schema: T.StructType) -> T.StructType:
    """The columns of a rejects table: the row, its problems, and a hash that identifies both."""
    extra = [T.StructField("problems", T.StringType()), T.StructField("reject_key", T.LongType())]
    return T.StructType([*schema.fields, *extra])


def append_new(
    batch: DataFrame,
    table: JdbcTable | ParquetTable,
    required: Sequence[str] = REQUIRED,
    rejects: JdbcTable | ParquetTable | None = None,
    stamped: str | None = None,
) -> Appended:
    """Append the rows whose key the table does not hold yet.

    foreachBatch repeats a batch after a failure, possibly when part of it was already written.
    Appending only missing keys makes the repeat harmless. A row whose key is stored with other
    values is a conflict, not a repeat; so are rows of one batch that share a key and differ (the
    first in the order of their values is written). Conflicts and rows that lack a required column
    go to `rejects`, or fail the write without it, before anything is written.

    The rejects table has reject_schema() and REJECT_KEY as its key, so that a repeated batch
    leaves each reject once. `stamped` names a column to add with the time of the write, for tables
    that do not fill it themselves. An empty batch touches no table.

    One job looks at the batch: its size, its days and time range, which limit the stored keys to be
    read (a batch has about as many days as it writes folders), and whether required columns are NULL. A key should have one writer at a time: two that append
    it at the same moment both find it missing.
    """
    spark = batch.sparkSession
    own_cache = not batch.is_cached
    if own_cache:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    judged = None
    try:
        checked = require_columns(batch, required)
        micros = F.unix_micros(table.time)
        facts = checked.agg(
            F.count("*").alias("rows"),
            F.count_if(F.size("problems") > 0).alias("flawed"),
            F.min(micros).alias("low"),
            F.max(micros).alias("high"),
            F.collect_set(utc_day(table.time).cast("string")).alias("days"),
        ).first()
        rows, flawed = facts["rows"], facts["flawed"]
        if not rows:
            return Appended()
        if flawed and rejects is None:
            raise ValueError(f"{flawed} rows lack one of {', '.join(required)}")
        good, bad = split_checked(checked)
        counts = {"new": 0, "repeat": 0, "conflict": 0}
        if rows > flawed:
            stored = _around(table, spark, facts["days"], facts["low"], facts["high"])
            judged = _judged(good, stored, list(table.key)).persist(StorageLevel.MEMORY_AND_DISK)
            counts |= {r["verdict"]: r["count"] for r in judged.groupBy("verdict").count().collect()}
            if counts["conflict"] and rejects is None:
                raise ValueError(f"{counts['conflict']} rows have a {CONFLICT}")
        if rejects is not None and (flawed or counts["conflict"]):
            lost = bad.withColumn("problems", F.concat_ws(", ", "problems"))
            if counts["conflict"]:
                clash = judged.where("verdict = 'conflict'").drop("verdict")
                lost = lost.unionByName(clash.withColumn("problems", F.lit(CONFLICT)))
            _append_rejects(lost, rejects, flawed + counts["conflict"])
        if counts["new"]:
            fresh = judged.where("verdict = 'new'").drop("verdict")
            if stamped:
                fresh = fresh.withColumn(stamped, F.current_timestamp())
            table.append(fresh, counts["new"])
        return Appended(rows, counts["new"], counts["repeat"], counts["conflict"], flawed)
    finally:
        if judged is not None:
            judged.unpersist()
        if own_cache:
            batch.unpersist()


def _around(table: JdbcTable | ParquetTable, spark: SparkSession, days: list[str], low: int, high: int) -> DataFrame:
    """The stored rows that a batch may repeat: those of its days, or of its time range in a database,
    whose index finds them."""
    if isinstance(table, ParquetTable):
        return table.near(spark, days, low, high)
    return table.between(spark, low, high)


def _values(columns: Sequence[str]) -> Column:
    return F.struct(*[F.col(name) for name in columns])


def _same(name: str, kind: T.DataType) -> Column:
    """Whether a value equals the stored one. Sums of doubles depend on their order in the last
    bits, so a repeated batch may differ from its first run by that much."""
    new, old = F.col(name), F.col("_stored")[name]
    if not isinstance(kind, (T.DoubleType, T.FloatType)):
        return new.eqNullSafe(old)
    near = F.abs(new - old) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(new), F.abs(old))
    return new.eqNullSafe(old) | F.coalesce(near, F.lit(False))


def _judged(good: DataFrame, stored: DataFrame, key: list[str]) -> DataFrame:
    """The rows with a verdict: new, repeat or conflict.

    Equal rows of the batch count as repeats of the first. A stored row is compared in the
    columns that the batch has too.
    """
    values = [name for name in good.columns if name not in key]
    compared = [name for name in values if name in stored.columns]
    held = stored.select(*key, _values(compared).alias("_stored") if compared else F.lit(True).alias("_stored"))
    # The least of a key's rows stands for it; the other groups are its rivals.
    groups = good.groupBy(*key, *values).agg(F.count("*").alias("_copies"))
    first = groups.groupBy(*key).agg(F.min(_values(values)).alias("_first"))
    same = reduce(and_, [_same(name, good.schema[name].dataType) for name in compared], F.lit(True))
    verdict = (
        F.when(F.col("_stored").isNotNull(), F.when(same, "repeat").otherwise("conflict"))
        .when(_values(values).eqNullSafe(F.col("_first")), F.when(F.col("_copy") == 1, "new").otherwise("repeat"))
        .otherwise("conflict")
    )
    return (
        groups.join(first, key)
        .join(held, key, "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies"))))
        .select(*good.columns, verdict.alias("verdict"))
    )


def _append_rejects(lost: DataFrame, rejects: JdbcTable | ParquetTable, rows: int) -> None:
    """Append rejects that are not there yet, known by a hash of the row and its problems."""
    keyed = lost.withColumn("reject_key", F.xxhash64(*lost.columns)).dropDuplicates(["reject_key"])
    micros = F.unix_micros(rejects.time)
    low, high, days = keyed.agg(F.min(micros), F.max(micros), F.collect_set(utc_day(rejects.time).cast("string"))).first()
    spark = lost.sparkSession
    stored = rejects.without_time(spark)
    if low is not None:
        stored = stored.unionByName(_around(rejects, spark, days, low, high))
    rejects.append(keyed.join(stored.select("reject_key"), "reject_key", "left_anti"), rows)
