"""Windows that a stream still holds open, read from its state.

A stream emits a bar once the watermark has passed its end; until then, and for good if the input
ends, the bar is in the query's state only. It can be read from there, by a batch query of its own,
whether the stream runs or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import ratio

# The partial results that Spark keeps of the measures of bars, in its order: sums and plain
# aggregates first in the order in which they are written, then variances, then computed sums.
_SPREAD = [("n", "double"), ("mean", "double"), ("squares", "double"), ("turnover", "double")]
_SUMS = [("total_volume", "double"), ("price_sum", "double"), ("prices", "bigint")]
_EXTREMES = [("min_price", "double"), ("max_price", "double"), ("trade_count", "bigint")]


def open_bars(spark: SparkSession, checkpoint: str, extremes: bool = True, batch_id: int | None = None) -> DataFrame:
    """The bars of the windows in the state of a query of bars(), by its checkpoint.

    `extremes` must be as in bars(); sliding windows of lateness="window" are read as well as tumbling
    ones. `batch_id` names the batch after which to read, the last one that ended by default. A
    state of another shape is refused. One scan of the state, no shuffle.
    """
    reader = spark.read.format("statestore")
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    state = reader.load(checkpoint)
    fields = [*_SUMS, *(_EXTREMES if extremes else []), *_SPREAD]
    held = state.schema["value"].dataType
    found = [f.dataType.simpleString() for f in held.fields]
    keys = [f.name for f in state.schema["key"].dataType.fields]
    if found != [kind for _, kind in fields] or keys != ["window", "symbol"]:
        raise ValueError(f"not the state of bars: {state.schema['key'].dataType.simpleString()}, {held.simpleString()}")
    named = F.col("value").cast(f"struct<{', '.join(f'{name}: {kind}' for name, kind in fields)}>")
    rows = state.select("key.window", "key.symbol", F.inline(F.array(named)))
    middle = [name for name, _ in _EXTREMES] if extremes else []
    return rows.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        "total_volume",
        ratio(F.col("price_sum"), F.col("prices")).alias("avg_price"),
        *middle,
        F.when(F.col("n") > 1, F.sqrt(F.col("squares") / (F.col("n") - 1))).alias("volatility"),
        ratio(F.col("turnover"), F.col("total_volume")).alias("vwap"),
    )


def with_open_bars(emitted: DataFrame, still_open: DataFrame) -> DataFrame:
    """The bars emitted and those still open, which are marked in the column `provisional`.

    A window that has been emitted since the state was read counts as emitted.
    """
    e, o = emitted.alias("e"), still_open.alias("o")
    same = (F.col("o.window_start") == F.col("e.window_start")) & F.col("o.symbol").eqNullSafe(F.col("e.symbol"))
    added = o.join(e, same, "left_anti").withColumn("provisional", F.lit(True))
    return emitted.withColumn("provisional", F.lit(False)).unionByName(added)
