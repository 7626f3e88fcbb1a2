"""Volume spikes against a mean that a stream carries on from batch to batch.

volume_spikes() compares bars with the mean of their own micro-batch. In steady operation a batch
closes one bar of a symbol, which is its own mean, so nothing can fire. Here every bar is compared
with the mean of all bars of its symbol so far, itself included.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions import ratio
from tickloom.operators.spikes import FACTOR

_HELD = "bars long, volume double"
_FOUND = """
    symbol string, start long, end long, total_volume double, avg_price double, vwap double, avg_volume double
"""


class _RunningMean(StatefulProcessor):
    """Holds the count and the sum of a symbol's bars; yields those above the mean so far."""

    def __init__(self, factor: float) -> None:
        self._factor = factor

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._held = handle.getValueState("held", _HELD)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        bars, volume = self._held.get() if self._held.exists() else (0, 0.0)
        for row in sorted(rows, key=lambda row: row.start):
            if row.total_volume is None:
                continue
            bars, volume = bars + 1, volume + row.total_volume
            mean = volume / bars
            if row.total_volume > mean * self._factor:
                yield Row(**{**row.asDict(), "avg_volume": mean})
        self._held.update((bars, volume))

    def close(self) -> None:
        pass


def running_spikes(bars: DataFrame, factor: float = FACTOR) -> DataFrame:
    """Bars whose volume exceeds `factor` times the mean of their symbol's bars up to and with them.

    On a stream of closed bars, one bar per window and symbol, the mean is state: a count and a
    sum per symbol, which a restarted query goes on with. A stream closes windows in order, so the result does
    not depend on how the input falls into batches. The two numbers stay for good: Spark forgets state
    by the clock only. A batch's bars of one symbol are put in order in one task.

    On a table the same comes from a window function over the symbol.

    Bars without a symbol are never spikes, and those without a volume count in no mean. The
    columns are those of volume_spikes().
    """
    named = bars.where(F.col("symbol").isNotNull()).select(
        "symbol", "window_start", "window_end", "total_volume", "avg_price", "vwap"
    )
    if bars.isStreaming:
        found = _on_stream(named, factor)
    else:
        so_far = Window.partitionBy("symbol").orderBy("window_start").rowsBetween(Window.unboundedPreceding, 0)
        found = named.withColumn("avg_volume", F.avg("total_volume").over(so_far))
        found = found.where(F.col("total_volume") > F.col("avg_volume") * F.lit(factor))
    return found.select(
        "symbol",
        "window_start",
        "window_end",
        "total_volume",
        "avg_volume",
        ratio(F.col("total_volume"), F.col("avg_volume")).alias("ratio"),
        "avg_price",
        "vwap",
    )


def _on_stream(bars: DataFrame, factor: float) -> DataFrame:
    # Times go through Python as numbers, which no session time zone can shift.
    plain = bars.select(
        "symbol",
        F.unix_micros("window_start").alias("start"),
        F.unix_micros("window_end").alias("end"),
        "total_volume",
        "avg_price",
        "vwap",
    )
    found = plain.groupBy("symbol").transformWithState(
        _RunningMean(factor),
        outputStructType=_FOUND,
        outputMode="append",
        timeMode="none",
    )
    return found.withColumns(
        {"window_start": F.timestamp_micros("start"), "window_end": F.timestamp_micros("end")}
    )
