"""Small builders for trades, envelopes and bars."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tickloom.schema import ENVELOPE, FULL_BAR
from tickloom.session import settings

BASE = datetime(2024, 6, 1, 14, 30, tzinfo=timezone.utc)


def at(seconds: float) -> datetime:
    """A moment after 14:30:00 UTC."""
    return BASE + timedelta(seconds=seconds)


def millis(moment: datetime) -> int:
    return int(moment.timestamp() * 1000)


def item(symbol, price, volume, moment):
    return {
        "p": price,
        "s": symbol,
        "t": None if moment is None else millis(moment),
        "v": volume,
        "c": None,
    }


def envelopes(spark, *rows):
    return spark.createDataFrame([{"type": kind, "data": data} for kind, data in rows], ENVELOPE)


TRADE_TEXT = "symbol string, price double, volume double, at string"


def trades(spark, *rows):
    """Rows of (symbol, price, volume, moment)."""
    texts = [(s, p, v, None if m is None else m.isoformat()) for s, p, v, m in rows]
    return spark.createDataFrame(texts, TRADE_TEXT).select(
        "symbol", "price", "volume", F.col("at").cast("timestamp").alias("event_time")
    )


def volume_bars(spark, symbol, volumes, first=BASE):
    """Consecutive 1-minute bars of one symbol with the given volumes."""
    rows = [
        (
            first + timedelta(minutes=i),
            first + timedelta(minutes=i + 1),
            symbol,
            float(volume),
            1.0,
            1.0,
            1.0,
            1,
            None,
            1.0,
        )
        for i, volume in enumerate(volumes)
    ]
    return spark.createDataFrame(rows, FULL_BAR)


def clock(df, *columns):
    """The given timestamp columns as HH:mm:ss text, so that no time zone gets in the way."""
    return df.withColumns({name: F.date_format(name, "HH:mm:ss") for name in columns})


def plan_of(df) -> str:
    with settings(df.sparkSession, {"spark.sql.maxMetadataStringLength": "10000"}):
        return df._jdf.queryExecution().executedPlan().toString()
