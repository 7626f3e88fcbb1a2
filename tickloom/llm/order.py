"""Numbering rows in a global order without one task that sees them all."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.session import store

RANGE_ROWS = 50_000  # rows of a range, about


def ranges_of(rows: DataFrame, count: int | None = None) -> int:
    """How many ranges to cut a table into so that each has RANGE_ROWS rows, about."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-(rows.count() if count is None else count) // RANGE_ROWS))


def numbered(rows: DataFrame, order: Sequence, ranges: int, group: str | None = None) -> DataFrame:
    """Stored rows with `part`, `local`, `index` (longs): their range of the order, their place among
    the rows of their group in that range, and among all rows of their group.

    `order` must begin with `group`, whose values are not NULL. Ranges are cut by Spark's range
    partitioning, so one group may fill many of them; only one row per range and group is counted
    over. Rows that are equal in the whole order get any of their places. Rows should be a stored
    table, since the ranges are drawn from them first.
    """
    schema = T.StructType([*rows.schema.fields, T.StructField("part", T.LongType()), T.StructField("local", T.LongType())])
    at = None if group is None else rows.columns.index(group)

    def place(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, n = TaskContext.get().partitionId(), None, 0
        for part in parts:
            local = range(n, n + part.num_rows)
            if at is not None:
                local = []
                for own in part.column(at).to_pylist():
                    n = n + 1 if own == last else 0
                    last = own
                    local.append(n)
            else:
                n += part.num_rows
            added = [pa.array([task] * part.num_rows, pa.int64()), pa.array(local, pa.int64())]
            yield pa.RecordBatch.from_arrays([*part.columns, *added], names=schema.names)

    sorted_rows = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    placed = store(sorted_rows.mapInArrow(place, schema), "placed")
    keys = ["part"] if group is None else ["part", group]
    counts = placed.groupBy(*keys).agg(F.count("*").alias("_n"))
    by = Window.partitionBy(*keys[1:]).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, F.coalesce(F.sum("_n").over(by), F.lit(0)).alias("_before"))
    return placed.join(before, keys).withColumn("index", F.col("_before") + F.col("local")).drop("_before")
