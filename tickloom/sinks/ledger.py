"""Appends of micro-batches that a ledger keeps from being written twice.

append_new() finds a repeated batch by its keys, which it reads back. Here the batch itself is
known: a ledger notes for each query which batch is being written and to which days, and when it is
done. A batch that is done is not written again, after one listing of a folder with a file or two. One
that was broken off has left files in folders of its own name, which are taken away before it is
written again. Neither depends on how many rows the table holds or how far apart the times of
the batch are.
"""

from __future__ import annotations

import json
from collections.abc import Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import utc_day
from tickloom.session import hadoop_path, path_exists, remove_path
from tickloom.sinks.keyed import REQUIRED, Appended, append_new
from tickloom.sinks.tables import JdbcTable, ParquetTable

_OPEN, _DONE = "open", "done"


@dataclass(frozen=True)
class BatchTable(ParquetTable):
    """A Parquet folder with a partition per UTC day, and in it one per batch.

    `batch` names what append() writes. Rows appended without a ledger are of the batch "plain".
    """

    batch: str = "plain"

    def _partitions(self) -> list[T.StructField]:
        return [*super()._partitions(), T.StructField("of_batch", T.StringType())]

    def append(self, df: DataFrame, rows: int | None = None) -> None:
        dated = df.select(*self.schema.names).withColumn("on_day", utc_day(self.time)).withColumn("of_batch", F.lit(self.batch))
        if rows is None:
            dated = dated.hint("rebalance", F.col("on_day"))
        else:
            dated = dated.repartition(1 + rows // self.rows_per_file, "on_day", *self.key)
        dated.write.mode("append").partitionBy("on_day", "of_batch").parquet(self.path)

    def take_back(self, spark: SparkSession, days: Collection[str | None]) -> None:
        """Delete what this table's batch has written to some days."""
        for day in days:
            remove_path(spark, f"{self._folder(day)}/of_batch={self.batch}")

    def compact(self, spark: SparkSession, first, last) -> None:
        raise ValueError("the files of a batch stay together, so that it can be taken back")


@dataclass(frozen=True)
class _NewBatch(BatchTable):
    """A batch table in which the batch at hand has no rows yet, and no other batch has its keys."""

    def near(self, spark: SparkSession, days: Collection[str | None], low: int, high: int) -> DataFrame:
        return spark.createDataFrame([], self.schema)


@dataclass(frozen=True)
class Ledger:
    """A folder with a folder per query, which holds `N.open` or `N.done` of its last batch N.

    A query is known by the id that its checkpoint keeps, so that a query with a new checkpoint, whose
    batches count from 0 again, is another one. One writer per query at a time.
    """

    path: str

    def last(self, spark: SparkSession, query: str) -> tuple[int, str] | None:
        """The last batch noted and its state; a batch that is open and done is done."""
        folder = f"{self.path}/{query}"
        if not path_exists(spark, folder):
            return None
        found, files = hadoop_path(spark, folder)
        names = [status.getPath().getName().split(".") for status in files.listStatus(found)]
        return max(((int(n), state) for n, state in names if state in (_OPEN, _DONE)), key=lambda x: (x[0], x[1] == _DONE), default=None)

    def days(self, spark: SparkSession, query: str, batch: int) -> list[str | None]:
        """The days that an open batch may have written to. A note that was broken off itself names
        none: nothing was written yet."""
        path, files = hadoop_path(spark, self._file(query, batch, _OPEN))
        stream = files.open(path)
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return []

    def note(self, spark: SparkSession, query: str, batch: int, state: str, days: Sequence[str | None] = ()) -> None:
        """Write a note, and remove those of earlier batches."""
        path, files = hadoop_path(spark, self._file(query, batch, state))
        stream = files.create(path, True)
        try:
            stream.write(bytearray(json.dumps(list(days)).encode()))
        finally:
            stream.close()
        if state == _DONE:
            for status in files.listStatus(path.getParent()):
                name = status.getPath().getName()
                if name != path.getName() and name.split(".")[0].isdigit() and int(name.split(".")[0]) <= batch:
                    files.delete(status.getPath(), False)

    def _file(self, query: str, batch: int, state: str) -> str:
        return f"{self.path}/{query}/{batch}.{state}"


def query_of(batch: DataFrame) -> str:
    """The id of the streaming query whose batch function is running."""
    found = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not found:
        raise ValueError("name the query: no streaming query is running here")
    return found


def append_batch(
    batch: DataFrame,
    batch_id: int,
    table: BatchTable,
    ledger: Ledger,
    query: str | None = None,
    required: Sequence[str] = REQUIRED,
    rejects: JdbcTable | ParquetTable | None = None,
    stamped: str | None = None,
) -> Appended | None:
    """Append a micro-batch once; None if the ledger has it as done.

    Within the batch, keys, required columns, rejects and stamps are treated as in append_new().
    Keys are not compared with those of other batches: a stream emits a closed window once, so that
    only a repeated batch could bring them again, and that is what the ledger finds. A batch below the last one
    noted is done as well, since queries go on in order.

    Broken off before its note, a batch has written nothing; between note and end, it is taken back
    and written again; after its end, it is computed, but not written. An empty batch is noted as done.
    """
    spark = batch.sparkSession
    query = query or query_of(batch)
    target = _NewBatch(**{**table.__dict__, "batch": f"{query}-{batch_id}"})
    last = ledger.last(spark, query)
    if last is not None and (last[0] > batch_id or last == (batch_id, _DONE)):
        # Computed all the same: the state of the query's windows moves on with it.
        batch.write.format("noop").mode("overwrite").save()
        return None
    if last == (batch_id, _OPEN):
        target.take_back(spark, ledger.days(spark, query, batch_id))
    own_cache = not batch.is_cached
    if own_cache:
        batch = batch.persist()
    try:
        # collect_set() leaves NULL out, which stands for rows without a time.
        days = F.collect_set(utc_day(table.time).cast("string"))
        found, timeless = batch.agg(days, F.count_if(F.col(table.time).isNull())).first()
        ledger.note(spark, query, batch_id, _OPEN, [*found, *([None] if timeless else [])])
        done = append_new(batch, target, required, rejects, stamped)
        ledger.note(spark, query, batch_id, _DONE)
        return done
    finally:
        if own_cache:
            batch.unpersist()
