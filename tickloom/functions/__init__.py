from tickloom.functions.columns import (
    event_time_from_millis,
    hour_parts,
    ratio,
    spans,
    utc_day,
    vwap,
    wire_body,
    wire_header,
)

__all__ = [
    "event_time_from_millis",
    "hour_parts",
    "ratio",
    "spans",
    "utc_day",
    "vwap",
    "wire_body",
    "wire_header",
]
