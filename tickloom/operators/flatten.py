"""From message envelopes to one row per trade."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import event_time_from_millis


def flatten_trades(envelopes: DataFrame) -> DataFrame:
    """One row (symbol, price, volume, event_time) per trade of the 'trade' envelopes.

    Other envelope types, and envelopes whose list is NULL or empty, yield nothing.
    """
    items = envelopes.where(F.col("type") == "trade").select(F.inline("data"))
    return items.select(
        F.col("s").alias("symbol"),
        F.col("p").alias("price"),
        F.col("v").alias("volume"),
        event_time_from_millis(F.col("t")).alias("event_time"),
    )


def allow_symbols(trades: DataFrame, symbols: Iterable[str]) -> DataFrame:
    """Keep only the trades of the listed symbols."""
    return trades.where(F.col("symbol").isin(*symbols))


def first_messages(envelopes: DataFrame, n: int, *arrival: str) -> DataFrame:
    """The first n envelopes in arrival order; n <= 0 means all of them.

    Without arrival columns, which a stream cannot sort by, it is whichever n come first.
    """
    if n <= 0:
        return envelopes
    return (envelopes.orderBy(*arrival) if arrival else envelopes).limit(n)
