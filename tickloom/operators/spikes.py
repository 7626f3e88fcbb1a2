"""Volume spikes: bars far above the mean volume of their symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import ratio

# Fixed value: a bar is a spike when its volume is above this many times the mean.
FACTOR = 3.0

# Into how many parts the bars of a symbol are spread when they are shuffled to their mean.
SALTS = 32


def mean_volumes(bars: DataFrame) -> DataFrame:
    """Mean bar volume per symbol, one row per symbol."""
    return bars.groupBy("symbol").agg(F.avg("total_volume").alias("avg_volume"))


def volume_spikes(bars: DataFrame, factor: float = FACTOR, salts: int = SALTS) -> DataFrame:
    """Bars whose volume exceeds `factor` times the mean over the given bars.

    The mean covers exactly the bars passed in, the spike included: in a stream that is
    one micro-batch. With non-negative volumes a symbol therefore needs more than
    `factor` bars to show a spike at all. Bars without a symbol are never spikes.

    The means come from a partial aggregate and meet the bars in a join rather than in a
    window over the symbol, which would put all bars of a symbol into one task. Spark
    broadcasts the means while their size allows it. Beyond that the `salts` copies of
    each mean spread a busy symbol over as many tasks. AQE may split those further, which
    it cannot without the salt: means grouped and joined by the same key need no shuffle
    of their own, and AQE splits only joins of two shuffles.

    `bars` is read twice, so pass a stored or cached table rather than a computation over
    raw trades.
    """
    salt = F.pmod(F.xxhash64("window_start"), F.lit(salts)).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    paired = bars.withColumn("salt", salt).join(
        mean_volumes(bars).withColumn("salt", copies), ["symbol", "salt"]
    )
    return paired.where(F.col("total_volume") > F.col("avg_volume") * F.lit(factor)).select(
        "symbol",
        "window_start",
        "window_end",
        "total_volume",
        "avg_volume",
        ratio(F.col("total_volume"), F.col("avg_volume")).alias("ratio"),
        "avg_price",
        "vwap",
    )
