"""A lake that streams write batch by batch, without the file sink's log.

Below each hour's folder there is one per batch, `of_batch=...`. A ledger inside the lake knows which
batches are done, so a repeated batch is not written twice, and one broken off is taken back. The
files of the lake are all that readers need: read_lake() prunes folders as in any lake, no log
grows with the number of files, and hours can be compacted while streams append to them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Collection
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import hour_parts
from tickloom.session import hadoop_path, path_exists, remove_path
from tickloom.sinks.ledger import _DONE, _OPEN, Ledger, query_of
from tickloom.sinks.tables import symbol_filter
from tickloom.sources.lake import LAKE, PARTS, lake_folders, read_lake

_STORED = T.StructType([*LAKE.fields, T.StructField("of_batch", T.StringType())])
_ORDER = (*PARTS, "of_batch", "symbol", "event_time")


@dataclass(frozen=True)
class BatchLake:
    """A lake folder with a partition per UTC hour, and in it one per batch.

    One writer per query at a time, any number of queries, and one compaction at a time. Folders whose names begin with an underscore
    hold the ledger and the notes of compactions; Spark's readers pass over them. `rows_per_file`
    bounds the files of a batch, of which a lone live hour gets one per so many rows.
    """

    path: str
    rows_per_file: int = 1_000_000

    @property
    def ledger(self) -> Ledger:
        return Ledger(f"{self.path}/_batches")

    def append(self, batch: DataFrame, batch_id: int, query: str | None = None) -> int | None:
        """Append a micro-batch of trades once; the number of its rows, None if it was there already.

        A trade without time goes to the hour NULL. `query` names the stream, the running one by
        default. Broken off, a batch leaves files that readers see until it is repeated, which Spark does first
        when the query starts again.
        """
        spark = batch.sparkSession
        query = query or query_of(batch)
        last = self.ledger.last(spark, query)
        if last is not None and (last[0] > batch_id or last == (batch_id, _DONE)):
            return None
        name = f"{query}-{batch_id}"
        if last == (batch_id, _OPEN):
            self._drop(spark, self.ledger.days(spark, query, batch_id), [name])
        own_cache = not batch.is_cached
        if own_cache:
            batch = batch.persist()
        try:
            placed = batch.withColumns(hour_parts("event_time"))
            folder = F.concat_ws("/", *[F.concat(F.lit(f"{p}="), _folder_text(p)) for p in PARTS])
            hours, rows = placed.agg(F.collect_set(folder), F.count("*")).first()
            self.ledger.note(spark, query, batch_id, _OPEN, sorted(hours))
            if rows:
                # The cached batch is there already, so fewer tasks only write it.
                self._write(placed.coalesce(1 + rows // self.rows_per_file), name, self.path)
            self.ledger.note(spark, query, batch_id, _DONE)
            return rows
        finally:
            if own_cache:
                batch.unpersist()

    def read(self, spark: SparkSession, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """As read_lake(); no trades before the first batch."""
        if not self._holds(spark):
            return spark.createDataFrame([], T.StructType(LAKE.fields[: -len(PARTS)]))
        return read_lake(spark, self.path, start, end)

    def compact(self, spark: SparkSession, start: datetime, end: datetime) -> int:
        """Rewrite the batches of the hours from start up to end (full hours, UTC) as one each; the
        number of hours that had several.

        Batches that are being written stay as they are, so streams may go on. The new files are made in a folder of their
        own and noted before any old one goes; if the exchange is broken off, the next call, for
        whatever hours, ends it first. While an hour is exchanged, readers that list it can miss it.
        """
        start, end = (m.replace(tzinfo=timezone.utc) if m.tzinfo is None else m.astimezone(timezone.utc) for m in (start, end))
        if any((m.minute, m.second, m.microsecond) != (0, 0, 0) for m in (start, end)):
            raise ValueError("start and end must be full hours")
        self.resume(spark)
        busy = self._open_batches(spark)
        olds: dict[str, list[str]] = {}
        for day in range((end - start).days + 1):
            low = start + timedelta(days=day)
            if low >= end:
                break
            for folder in lake_folders(self.path, low, min(end, low + timedelta(days=1))):
                names = [n for n in self._batches(spark, folder) if n not in busy]
                if len(names) > 1:
                    olds[folder.removeprefix(f"{self.path}/")] = names
        if not olds:
            return 0
        mark = uuid.uuid4().hex
        staged, new = f"{self.path}/_compaction/{mark}", f"compacted-{mark}"
        folders = [f"{self.path}/{hour}/of_batch={name}" for hour, names in olds.items() for name in names]
        rows = spark.read.schema(_STORED).option("basePath", self.path).parquet(*folders).drop("of_batch")
        self._write(rows.hint("rebalance", *[F.col(p) for p in PARTS]), new, staged)
        self._note(spark, mark, json.dumps({"new": new, "olds": olds}))
        self.resume(spark)
        return len(olds)

    def resume(self, spark: SparkSession) -> None:
        """End compactions that were broken off in their exchange, and forget those before it."""
        base = f"{self.path}/_compaction"
        if not path_exists(spark, base):
            return
        folder, files = hadoop_path(spark, base)
        names = [status.getPath().getName() for status in files.listStatus(folder)]
        for mark in [n.removesuffix(".ready") for n in names if n.endswith(".ready")]:
            plan = json.loads(self._noted(spark, mark))
            for hour, olds in plan["olds"].items():
                leaf = f"{hour}/of_batch={plan['new']}"
                # Moved last: while the new files wait, old ones may be left.
                if path_exists(spark, f"{base}/{mark}/{leaf}"):
                    self._drop(spark, [hour], olds)
                    source, target = (hadoop_path(spark, f"{p}/{leaf}")[0] for p in (f"{base}/{mark}", self.path))
                    if not files.rename(source, target):
                        raise OSError(f"could not move {source}")
            remove_path(spark, f"{base}/{mark}.ready")
        remove_path(spark, base)

    def _write(self, placed: DataFrame, name: str, path: str) -> None:
        rows = placed.select(*LAKE.names, F.lit(name).alias("of_batch"))
        (
            rows.sortWithinPartitions(*_ORDER)
            .write.mode("append")
            .option("compression", "snappy")
            .options(**symbol_filter(LAKE))
            .partitionBy(*PARTS, "of_batch")
            .parquet(path)
        )

    def _drop(self, spark: SparkSession, hours: Collection[str], names: Collection[str]) -> None:
        for hour in hours:
            for name in names:
                remove_path(spark, f"{self.path}/{hour}/of_batch={name}")

    def _batches(self, spark: SparkSession, folder: str) -> list[str]:
        """The batches of an hour."""
        if not path_exists(spark, folder):
            return []
        found, files = hadoop_path(spark, folder)
        names = [s.getPath().getName() for s in files.listStatus(found)]
        return sorted(n.removeprefix("of_batch=") for n in names if n.startswith("of_batch="))

    def _open_batches(self, spark: SparkSession) -> set[str]:
        if not path_exists(spark, self.ledger.path):
            return set()
        found, files = hadoop_path(spark, self.ledger.path)
        queries = [s.getPath().getName() for s in files.listStatus(found)]
        lasts = [(q, self.ledger.last(spark, q)) for q in queries]
        return {f"{q}-{last[0]}" for q, last in lasts if last is not None and last[1] == _OPEN}

    def _holds(self, spark: SparkSession) -> bool:
        if not path_exists(spark, self.path):
            return False
        found, files = hadoop_path(spark, self.path)
        return any(s.getPath().getName().startswith("year=") for s in files.listStatus(found))

    def _note(self, spark: SparkSession, mark: str, text: str) -> None:
        """A note appears whole or not at all."""
        path, files = hadoop_path(spark, f"{self.path}/_compaction/{mark}.new")
        stream = files.create(path, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        files.rename(path, hadoop_path(spark, f"{self.path}/_compaction/{mark}.ready")[0])

    def _noted(self, spark: SparkSession, mark: str) -> str:
        path, files = hadoop_path(spark, f"{self.path}/_compaction/{mark}.ready")
        stream = files.open(path)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def _folder_text(part: str):
    return F.coalesce(F.col(part).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__"))
