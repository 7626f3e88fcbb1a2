"""Event-time bars per symbol over tumbling and sliding windows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from tickloom.functions import ratio, spans, vwap

# Window lengths and late-data delays of the two stored bar tables.
MINUTE = timedelta(minutes=1)
FIVE_MINUTES = timedelta(minutes=5)
DELAY_1MIN = timedelta(seconds=10)
DELAY_5MIN = timedelta(seconds=30)

# A block of window starts holds at least this many, and never fewer than a window has panes, so
# that no window spans three blocks.
PANES_PER_BLOCK = 64


def bars(
    trades: DataFrame,
    width: timedelta,
    slide: timedelta | None = None,
    delay: timedelta | None = None,
    extremes: bool = True,
    panes: bool = True,
    lateness: str = "window",
) -> DataFrame:
    """Volume, price and volatility per (window, symbol), on a table or on a stream.

    `delay` is the watermark of a stream. `extremes` adds min_price, max_price and
    trade_count. Rows without an event time belong to no window.

    On a table, sliding windows are built from panes: the trades are aggregated into tumbling
    windows of length `slide`, and only those are copied into the width/slide windows they
    belong to, behind the last shuffle. So neither raw rows nor shuffled rows are multiplied.
    `panes=False` uses the direct plan.

    A stream with sliding windows tests lateness per window by default: a late trade is dropped from the
    windows that have closed and counts in those that have not. That takes the direct plan, which copies
    every trade into width/slide windows and keeps the state of all of them. With
    lateness="pane" trades go into panes, whose state is that of one window, and a second stateful
    aggregation puts closed panes together; a trade is dropped as a whole once its pane has
    closed. Without late trades both give the same bars, at the same watermark.
    """
    if lateness not in ("window", "pane"):
        raise ValueError(f"lateness must be 'window' or 'pane', not {lateness!r}")
    if delay is not None:
        trades = trades.withWatermark("event_time", spans(delay))
    if slide is None or slide == width:
        return _direct(trades, F.window("event_time", spans(width)), extremes)
    whole = width % slide == timedelta(0)
    if trades.isStreaming and lateness == "pane":
        if not whole:
            raise ValueError("panes need a width that is a multiple of the slide")
        return _from_closed_panes(trades, width, slide, extremes)
    if panes and whole and not trades.isStreaming:
        return _from_panes(trades, width, slide, extremes)
    return _direct(trades, F.window("event_time", spans(width), spans(slide)), extremes)


def bars_1min(trades: DataFrame) -> DataFrame:
    """1-minute tumbling bars; a stream waits 10 seconds for late trades."""
    return bars(trades, MINUTE, delay=DELAY_1MIN)


def bars_5min(trades: DataFrame, panes: bool = True, lateness: str = "window") -> DataFrame:
    """5-minute bars, one starting every minute; a stream waits 30 seconds for late trades.

    `panes=False` suits tables with hardly more than a trade per symbol and minute; `lateness` see bars().
    """
    return bars(trades, FIVE_MINUTES, MINUTE, delay=DELAY_5MIN, extremes=False, panes=panes, lateness=lateness)


def _layout(extremes: bool) -> list[Column | str]:
    middle = ["min_price", "max_price", "trade_count"] if extremes else []
    return [
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        "symbol",
        "total_volume",
        "avg_price",
        *middle,
        "volatility",
        "vwap",
    ]


def _direct(trades: DataFrame, window: Column, extremes: bool) -> DataFrame:
    price, volume = F.col("price"), F.col("volume")
    measures = [
        F.sum(volume).alias("total_volume"),
        F.avg(price).alias("avg_price"),
        F.stddev_samp(price).alias("volatility"),
        vwap(price, volume).alias("vwap"),
    ]
    if extremes:
        measures += [
            F.min(price).alias("min_price"),
            F.max(price).alias("max_price"),
            F.count("*").alias("trade_count"),
        ]
    grouped = trades.groupBy(window.alias("window"), "symbol").agg(*measures)
    return grouped.select(*_layout(extremes))


def _from_panes(
    trades: DataFrame, width: timedelta, slide: timedelta, extremes: bool
) -> DataFrame:
    count = width // slide
    step = slide // timedelta(microseconds=1)
    panes = _panes(trades, slide).withColumn("pane", F.unix_micros(F.col("window.start"))).drop("window")

    # Windows are put together in blocks of neighbouring starts. A pane is shuffled once, to
    # the block it lies in and, near a block's edge, also to the one before. So a window finds
    # all its panes in one place, and copying panes into windows needs no shuffle: explode()
    # keeps the partitioning, where a sliding window() would lose it.
    block = step * max(PANES_PER_BLOCK, count)
    earliest = F.col("pane") - F.lit(step * (count - 1))
    blocks = F.array_distinct(F.array(_block(earliest, block), _block(F.col("pane"), block)))
    starts = F.sequence(earliest, F.col("pane"), F.lit(step))
    placed = (
        panes.withColumn("block", F.explode(blocks))
        .repartition("symbol", "block")
        .select("*", F.explode(starts).alias("start"))
        .where(_block(F.col("start"), block) == F.col("block"))
    )

    merged = _merged(placed.groupBy("symbol", "block", "start"), extremes)
    ends = F.col("start") + F.lit(width // timedelta(microseconds=1))
    window = F.struct(F.timestamp_micros("start").alias("start"), F.timestamp_micros(ends).alias("end"))
    return merged.withColumn("window", window).select(*_layout(extremes))


def _from_closed_panes(
    trades: DataFrame, width: timedelta, slide: timedelta, extremes: bool
) -> DataFrame:
    """On a stream: a stateful aggregation into panes, and one of the panes that have closed."""
    panes = _panes(trades, slide)
    # A pane lies wholly in a window or not at all, so its last microsecond stands for it.
    window = F.window(F.window_time("window"), spans(width), spans(slide))
    placed = panes.withColumn("window", window)
    return _merged(placed.groupBy("window", "symbol"), extremes).select(*_layout(extremes))


def _panes(trades: DataFrame, slide: timedelta) -> DataFrame:
    return _in_panes(trades, slide).agg(*_pane_measures())


def _in_panes(trades: DataFrame, slide: timedelta) -> GroupedData:
    return trades.groupBy(F.window("event_time", spans(slide)).alias("window"), "symbol")


def _pane_measures() -> list[Column]:
    price, volume = F.col("price"), F.col("volume")
    return [
        F.sum(volume).alias("volume"),
        F.sum(price * volume).alias("turnover"),
        F.sum(price).alias("price_sum"),
        F.count(price).alias("prices"),
        F.avg(price).alias("mean"),
        F.var_pop(price).alias("variance"),
        F.min(price).alias("low"),
        F.max(price).alias("high"),
        F.count("*").alias("trades"),
    ]


def _merged(windows: GroupedData, extremes: bool) -> DataFrame:
    """The measures of windows from those of their panes.

    A window has at most width/slide panes, so the list of their means is bounded. It is folded
    around the window's own mean, which keeps the variance stable.
    """
    pane = F.when(F.col("prices") > 0, F.struct("prices", "mean", "variance"))
    measures = [
        F.sum("volume").alias("total_volume"),
        F.sum("turnover").alias("turnover"),
        F.sum("price_sum").alias("price_sum"),
        F.sum("prices").alias("prices"),
        F.collect_list(pane).alias("panes"),
    ]
    if extremes:
        measures += [
            F.min("low").alias("min_price"),
            F.max("high").alias("max_price"),
            F.sum("trades").alias("trade_count"),
        ]
    merged = windows.agg(*measures).withColumn("avg_price", ratio(F.col("price_sum"), F.col("prices")))
    squares = F.aggregate(
        "panes",
        F.lit(0.0),
        lambda total, p: total + p["prices"] * (p["variance"] + F.pow(p["mean"] - F.col("avg_price"), F.lit(2))),
    )
    spread = squares / (F.col("prices") - 1)
    return merged.withColumns(
        {
            "volatility": F.when(F.col("prices") > 1, F.sqrt(spread)),
            "vwap": ratio(F.col("turnover"), F.col("total_volume")),
        }
    )


def _block(start: Column, length: int) -> Column:
    """The block of window starts that a moment in microseconds lies in."""
    return F.floor(start / F.lit(length))
