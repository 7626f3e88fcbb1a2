"""Checks of envelopes and trades against the declared message rules.

Each check adds one `problems` column that lists the broken rules, in one pass and without
a shuffle; `split_checked` then separates good rows from rejects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The only envelope type allowed and the declared symbol pattern.
ENVELOPE_TYPE = "trade"
SYMBOL_PATTERN = "^[A-Z]+:[A-Z]+$"


def _listed(rules: dict[str, Column]) -> Column:
    broken = [F.when(condition, F.lit(name)) for name, condition in rules.items()]
    return F.array_compact(F.array(*broken))


def check_envelopes(envelopes: DataFrame, symbol_pattern: str | None = None) -> DataFrame:
    """Add `problems` to envelopes; one bad trade makes its whole envelope bad.

    The symbol pattern is off by default, since plain tickers do not match it.
    """

    def any_item(condition) -> Column:
        return F.coalesce(F.exists("data", condition), F.lit(False))

    rules = {
        "type missing": F.col("type").isNull(),
        "type unknown": F.col("type") != ENVELOPE_TYPE,
        "data missing": F.col("data").isNull(),
        "price missing": any_item(lambda d: d["p"].isNull()),
        "symbol missing": any_item(lambda d: d["s"].isNull()),
        "time missing": any_item(lambda d: d["t"].isNull()),
        "volume missing": any_item(lambda d: d["v"].isNull()),
        "time negative": any_item(lambda d: d["t"] < 0),
        "volume negative": any_item(lambda d: d["v"] < 0),
    }
    if symbol_pattern is not None:
        rules["symbol malformed"] = any_item(lambda d: ~d["s"].rlike(symbol_pattern))
    return envelopes.withColumn("problems", _listed(rules))


def check_trades(trades: DataFrame, symbol_pattern: str | None = None) -> DataFrame:
    """Add `problems` to flattened trades."""
    rules = {
        "price missing": F.col("price").isNull(),
        "symbol missing": F.col("symbol").isNull(),
        "time missing": F.col("event_time").isNull(),
        "volume missing": F.col("volume").isNull(),
        "time negative": F.unix_micros("event_time") < 0,
        "volume negative": F.col("volume") < 0,
    }
    if symbol_pattern is not None:
        rules["symbol malformed"] = ~F.col("symbol").rlike(symbol_pattern)
    return trades.withColumn("problems", _listed(rules))


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `problems` naming the required columns that are NULL."""
    return df.withColumn(
        "problems", _listed({f"{name} missing": F.col(name).isNull() for name in columns})
    )


def split_checked(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without `problems`, rejected rows with it)."""
    clean = F.size("problems") == 0
    return checked.where(clean).drop("problems"), checked.where(~clean)
