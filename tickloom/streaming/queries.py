"""Starting streaming queries and waiting for them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom.session import STREAM_SETTINGS, settings


def start_query(
    df: DataFrame | DataStreamWriter,
    sink: str | Callable[[DataFrame, int], None] | None = None,
    checkpoint: str | None = None,
    mode: str | None = None,
    trigger: dict[str, Any] | None = None,
    state_partitions: int | None = None,
    name: str | None = None,
    **options: Any,
) -> StreamingQuery:
    """Start a query into a sink format (parquet, kafka, ...; console if none is given) or a batch
    function, in append mode unless told otherwise.

    A DataStreamWriter, such as lake_stream() makes, has a sink and a mode of its own. Every query
    needs a checkpoint in a folder that outlives the driver, but for those into the console or
    into memory. `trigger`
    holds the arguments of DataStreamWriter.trigger, e.g. {"availableNow": True}; without
    it batches follow each other at once. `state_partitions` is the number of shuffle
    partitions and state stores, which the first checkpoint fixes for good: it should suit
    the cluster, not the first day's data. Spark has no streaming JDBC format; write to a
    database with a batch function.
    """
    if isinstance(df, DataStreamWriter):
        if sink is not None or mode is not None:
            raise ValueError("a DataStreamWriter has its own sink and mode")
        writer, spark = df, df._spark
    else:
        sink = "console" if sink is None else sink
        writer, spark = df.writeStream.outputMode(mode or "append"), df.sparkSession
        writer = writer.foreachBatch(sink) if callable(sink) else writer.format(sink)
    if checkpoint is None and sink not in ("console", "memory"):
        raise ValueError("a query needs a checkpoint folder")
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if trigger is not None:
        writer = writer.trigger(**trigger)
    if name is not None:
        writer = writer.queryName(name)
    held = dict(STREAM_SETTINGS)
    if state_partitions is not None:
        held["spark.sql.shuffle.partitions"] = str(state_partitions)
    with settings(spark, held):
        return writer.options(**options).start()


def wait_for_any(queries: Sequence[StreamingQuery]) -> None:
    """Return when one of the queries ends, raising its error if it failed.

    Those that still run are stopped, so that none of them goes on alone. Other queries of the
    session are left alone.
    """
    try:
        while all(query.isActive for query in queries):
            _await_one(queries)
    finally:
        for query in queries:
            query.stop()
    _raise_failures(queries)


def wait_for_all(queries: Sequence[StreamingQuery]) -> None:
    """Wait until every query has ended, as after an availableNow trigger.

    If one fails, its error is raised at once and the others are stopped.
    """
    try:
        while any(query.isActive for query in queries):
            _raise_failures(queries)
            _await_one([query for query in queries if query.isActive])
        _raise_failures(queries)
    finally:
        for query in queries:
            query.stop()


def _await_one(queries: Sequence[StreamingQuery], seconds: float = 0.2) -> None:
    for query in queries[:1]:
        query.awaitTermination(seconds)


def _raise_failures(queries: Sequence[StreamingQuery]) -> None:
    for query in queries:
        if not query.isActive and query.exception() is not None:
            raise query.exception()
