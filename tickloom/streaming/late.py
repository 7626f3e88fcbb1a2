"""An account of trades that come too late for their windows.

Spark drops such rows without a trace but a number in the progress of the query. DroppedRows keeps
the sums of these numbers. lake_batches() puts the trades themselves aside: it writes all trades to
a lake, and those that came after the end of their windows to a second one as well.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tickloom.session import hadoop_path, path_exists
from tickloom.sinks.batch_lake import BatchLake
from tickloom.sinks.ledger import query_of

MICRO = timedelta(microseconds=1)


class DroppedRows(StreamingQueryListener):
    """Sums of the rows that queries have dropped behind their watermarks, by query id.

    To be added with spark.streams.addListener(). Spark counts what reaches the state: trades of one
    window and symbol that one task has combined before count as one. The sums are those of this
    session; what ran before it is not included.
    """

    def __init__(self) -> None:
        self._sums: dict[str, int] = defaultdict(int)
        self._lock = Lock()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        dropped = sum(o.numRowsDroppedByWatermark for o in event.progress.stateOperators)
        with self._lock:
            self._sums[str(event.progress.id)] += dropped

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def of(self, query_id: str) -> int:
        with self._lock:
            return self._sums.get(str(query_id), 0)


@dataclass(frozen=True)
class Marks:
    """A folder that keeps, per query and batch, the latest event time of all batches before it.

    So a repeated batch is judged by the mark it was judged by first.
    """

    path: str

    def before(self, spark: SparkSession, query: str, batch: int) -> int | None:
        """Microseconds since the epoch; None if nothing came before."""
        name = f"{self.path}/{query}/{batch}.json"
        if not path_exists(spark, name):
            return None
        path, files = hadoop_path(spark, name)
        stream = files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def keep(self, spark: SparkSession, query: str, batch: int, mark: int | None) -> None:
        """Note the mark for a batch, and forget those of batches that cannot be repeated."""
        folder = f"{self.path}/{query}"
        path, files = hadoop_path(spark, f"{folder}/{batch}.json")
        # Written aside and moved, so that a note broken off is none.
        aside = hadoop_path(spark, f"{folder}/{batch}.new")[0]
        stream = files.create(aside, True)
        try:
            stream.write(bytearray(json.dumps(mark).encode()))
        finally:
            stream.close()
        files.delete(path, False)
        if not files.rename(aside, path):
            raise OSError(f"could not move {aside}")
        for status in files.listStatus(path.getParent()):
            number = status.getPath().getName().split(".")[0]
            if number.isdigit() and int(number) < batch - 1:
                files.delete(status.getPath(), False)


def windows_end(time: str, width: timedelta, slide: timedelta | None = None) -> Column:
    """The end of the last window that holds a time, in microseconds since the epoch."""
    step = (slide or width) // MICRO
    micros = F.unix_micros(time)
    return micros - F.pmod(micros, F.lit(step)) + F.lit(width // MICRO)


def came_late(mark: int, width: timedelta, delay: timedelta, slide: timedelta | None = None) -> Column:
    """Whether all windows of a trade had ended `delay` before the latest time seen (`mark`)."""
    return windows_end("event_time", width, slide) <= F.lit(mark - delay // MICRO)


def lake_batches(
    lake: BatchLake,
    late: BatchLake | None = None,
    marks: Marks | None = None,
    width: timedelta = timedelta(minutes=1),
    delay: timedelta = timedelta(seconds=10),
    slide: timedelta | None = None,
    report: Callable[[int, int, int], None] | None = None,
    query: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A batch function: all trades to `lake`, and the late ones to `late` too.

    A trade is late if all windows it belongs to (of `width`, tumbling or by `slide`) ended at or before the latest
    event time of the batches before its own, less `delay`: a bound that is computed here, the same
    for every repeat of a batch. Spark's own watermark lags behind it by up to a batch, so a trade put aside
    may still have been counted in a bar, but none is dropped without being here, if the bars' query takes
    in the same batches. Trades without time are in no window and never late.

    `report` hears (batch, trades, late trades) of each batch that was not there already. `query`
    names the stream, the running one by default.
    """
    if (late is None) != (marks is None):
        raise ValueError("late trades need both a lake and marks")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, query or query_of(batch)
        batch = batch.persist()
        try:
            found = 0
            if marks is not None:
                mark = marks.before(spark, name, batch_id)
                if mark is not None:
                    aside = batch.where(came_late(mark, width, delay, slide))
                    found = late.append(aside, batch_id, name)
                latest = batch.agg(F.max(F.unix_micros("event_time"))).first()[0]
                known = [m for m in (mark, latest) if m is not None]
                marks.keep(spark, name, batch_id + 1, max(known, default=None))
            rows = lake.append(batch, batch_id, name)
            if report is not None and rows is not None:
                report(batch_id, rows, found or 0)
        finally:
            batch.unpersist()

    return write
