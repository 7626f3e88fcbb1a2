"""From a batch run to a stream that goes on where it ended.

A batch run over the trades so far gives the bars of all windows that have ended, and leaves the
panes of those still open as seeds. A stream of the trades that follow takes the seeds as its first
rows: the bars of the run and of the stream together are those of one run over all trades.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import ratio, spans
from tickloom.operators.bars import _in_panes, _layout, _merged, _pane_measures, bars
from tickloom.schema import TRADE

MICRO = timedelta(microseconds=1)
_SEED = T.StructType(
    [
        *[T.StructField(name, T.DoubleType()) for name in ("volume", "turnover", "price_sum")],
        T.StructField("prices", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in ("mean", "variance", "low", "high")],
        T.StructField("trades", T.LongType()),
    ]
)
_SEEDS = T.StructType([f for f in TRADE.fields if f.name in ("symbol", "event_time")] + [T.StructField("seed", _SEED)])


def hand_over(
    trades: DataFrame,
    path: str,
    width: timedelta,
    slide: timedelta | None = None,
    delay: timedelta = timedelta(0),
    extremes: bool = True,
) -> DataFrame:
    """The bars of a table's windows that have ended, as bars() gives them; those still open are left
    at `path` for go_on().

    A window has ended if it ends `delay` or more before the latest trade of the table, as for a stream.
    Seeds are a row per open pane and symbol, whatever the number of trades, with the time of
    the pane's latest trade. `path` must be a new folder in a place that outlives the stream, which reads it again when
    it restarts. The table is read for its latest time, for its bars, and its end for the seeds.
    """
    spark = trades.sparkSession
    slide = slide or width
    if width % slide:
        raise ValueError("panes need a width that is a multiple of the slide")
    latest = trades.agg(F.max(F.unix_micros("event_time"))).first()[0]
    mark = None if latest is None else latest - delay // MICRO
    # A pane belongs to an open window if it starts less than `width` before the mark.
    open_from = 0 if mark is None else mark - width // MICRO
    recent = trades.where(F.col("event_time") > F.timestamp_micros(F.lit(open_from - slide // MICRO)))
    panes = _in_panes(recent, slide).agg(*_pane_measures(), F.max("event_time").alias("event_time"))
    seeds = panes.where(F.unix_micros("window.start") > open_from).select(
        "symbol", "event_time", F.struct(*_SEED.names).alias("seed")
    )
    # A micro-batch reads few files as well as many: one per million seeds or so.
    seeds.hint("rebalance").write.mode("error").parquet(f"{path}/seeds")
    spark.createDataFrame([(mark,)], "mark long").coalesce(1).write.mode("error").parquet(f"{path}/mark")
    return bars(trades, width, slide, extremes=extremes).where(_ended(F.unix_micros("window_end"), mark))


def go_on(
    trades: DataFrame,
    path: str,
    width: timedelta,
    slide: timedelta | None = None,
    delay: timedelta = timedelta(0),
    extremes: bool = True,
) -> DataFrame:
    """The bars of a stream that follows a hand_over() with the same arguments.

    Trades whose pane had ended before the hand-over are late and dropped, as are later ones behind the
    watermark; with sliding windows lateness is judged per pane. The state is that of panes, and of the windows put
    together from them if they slide.
    """
    spark = trades.sparkSession
    slide = slide or width
    mark = spark.read.schema("mark long").parquet(f"{path}/mark").first()[0]
    seeds = spark.readStream.schema(_SEEDS).parquet(f"{path}/seeds")
    step, micros = F.lit(slide // MICRO), F.unix_micros("event_time")
    rows = trades.where(~_ended(micros - F.pmod(micros, step) + step, mark)).select(*TRADE.names).unionByName(seeds, allowMissingColumns=True)
    # One watermark over both, so that neither side holds back the other.
    marked = rows.withWatermark("event_time", spans(delay))
    counted = [F.count_if(F.col("seed").isNull()).alias("trades") if name == "trades" else m for name, m in zip(_SEED.names, _pane_measures(), strict=True)]
    found = _in_panes(marked, slide).agg(*counted, F.max("seed").alias("seed"))
    panes = found.withColumns(_joined())
    if slide == width:
        return _bars_of(panes).select(*_layout(extremes))
    window = F.window(F.window_time("window"), spans(width), spans(slide))
    placed = panes.withColumn("window", window).where(~_ended(F.unix_micros("window.end"), mark))
    return _merged(placed.groupBy("window", "symbol"), extremes).select(*_layout(extremes))


def _ended(end: Column, mark: int | None) -> Column:
    """Whether a window was closed at the hand-over. False without a time, which is in no window."""
    return F.lit(False) if mark is None else F.coalesce(end <= F.lit(mark), F.lit(False))


def _joined() -> dict[str, Column]:
    """The measures of a pane from those of the trades that came and of its seed, if there is one."""
    seed = {name: F.col("seed")[name] for name in _SEED.names}

    def added(name: str) -> Column:
        return F.coalesce(F.col(name) + seed[name], F.col(name), seed[name])

    count, more = F.col("prices"), F.coalesce(seed["prices"], F.lit(0))
    mean = ratio(
        F.coalesce(count * F.col("mean"), F.lit(0.0)) + F.coalesce(more * seed["mean"], F.lit(0.0)), count + more
    )

    def squares(n: Column, own: Column, variance: Column) -> Column:
        return F.coalesce(n * (variance + F.pow(own - mean, F.lit(2))), F.lit(0.0))

    total = squares(count, F.col("mean"), F.col("variance")) + squares(more, seed["mean"], seed["variance"])
    return {
        **{name: added(name) for name in ("volume", "turnover", "price_sum", "prices", "trades")},
        "mean": mean,
        "variance": ratio(total, count + more),
        "low": F.least("low", seed["low"]),
        "high": F.greatest("high", seed["high"]),
    }


def _bars_of(panes: DataFrame) -> DataFrame:
    """Tumbling windows are their panes."""
    n = F.col("prices")
    return panes.select(
        "window",
        "symbol",
        F.col("volume").alias("total_volume"),
        ratio(F.col("price_sum"), n).alias("avg_price"),
        F.col("low").alias("min_price"),
        F.col("high").alias("max_price"),
        F.col("trades").alias("trade_count"),
        F.when(n > 1, F.sqrt(F.col("variance") * n / (n - 1))).alias("volatility"),
        ratio(F.col("turnover"), F.col("volume")).alias("vwap"),
    )
