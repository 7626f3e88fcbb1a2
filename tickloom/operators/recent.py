"""Most-recent reports over the stored tables. Both are top-k plans: no full sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent_bars(bars: DataFrame, n: int = 20) -> DataFrame:
    """The n latest bars; bars of the same window come in symbol order."""
    return (
        bars.select("window_start", "symbol", "avg_price", "vwap", "trade_count")
        .orderBy(F.desc("window_start"), "symbol")
        .limit(n)
    )


def recent_anomalies(anomalies: DataFrame, n: int = 50) -> DataFrame:
    """The n anomalies detected last; ties come in symbol and window order."""
    return anomalies.orderBy(F.desc("detected_at"), "symbol", "window_start").limit(n)
