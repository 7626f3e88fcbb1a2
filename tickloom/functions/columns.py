"""Column expressions shared by the operators. All of them run inside the JVM."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def event_time_from_millis(millis: Column) -> Column:
    """Epoch milliseconds to TIMESTAMP, without a detour over floating point."""
    return F.timestamp_millis(millis)


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL for a zero divisor, also under ANSI mode."""
    return F.try_divide(top, bottom)


def vwap(price: Column, volume: Column) -> Column:
    """Volume-weighted average price; NULL when nothing was traded."""
    return ratio(F.sum(price * volume), F.sum(volume))


def utc_day(event_time: str) -> Column:
    """The UTC date of a timestamp, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(event_time) / 86_400).cast("int"))


def hour_parts(event_time: str) -> dict[str, Column]:
    """The lake's partition columns for an event-time column, in layout order and in UTC."""
    day = utc_day(event_time)
    return {
        "year": F.year(day),
        "month": F.month(day),
        "day": F.dayofmonth(day),
        "hour": F.pmod(F.floor(F.unix_seconds(event_time) / 3_600), F.lit(24)).cast("int"),
    }


def spans(length: timedelta) -> str:
    """A timedelta as the interval text that window() and withWatermark() take."""
    return f"{length // timedelta(microseconds=1)} microseconds"


def wire_body(value: Column) -> Column:
    """The Avro body of a framed message: everything behind the 5-byte header."""
    return F.substring(value, 6, F.greatest(F.length(value) - 5, F.lit(0)))


def wire_header(schema_id: int) -> Column:
    """Magic byte 0 followed by the schema id as 4 big-endian bytes."""
    return F.lit(bytes([0]) + schema_id.to_bytes(4, "big"))
