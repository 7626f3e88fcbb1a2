"""Row types that the operators exchange."""

from __future__ import annotations

import json

from pyspark.sql import types as T

# Field names and types of the wire envelope and of the stored tables.
TRADE_ITEM = T.StructType(
    [
        T.StructField("p", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("t", T.LongType()),
        T.StructField("v", T.DoubleType()),
        T.StructField("c", T.ArrayType(T.StringType())),
    ]
)

ENVELOPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("data", T.ArrayType(TRADE_ITEM)),
    ]
)

# The same envelope without the conditions list, which no operator reads. A scan or a
# decode that is given this schema never touches the list.
SLIM_ENVELOPE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField(
            "data",
            T.ArrayType(T.StructType([f for f in TRADE_ITEM.fields if f.name != "c"])),
        ),
    ]
)

TRADE = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

_BAR_KEY = [
    T.StructField("window_start", T.TimestampType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("symbol", T.StringType()),
]

FULL_BAR = T.StructType(
    _BAR_KEY
    + [
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("min_price", T.DoubleType()),
        T.StructField("max_price", T.DoubleType()),
        T.StructField("trade_count", T.LongType()),
        T.StructField("volatility", T.DoubleType()),
        T.StructField("vwap", T.DoubleType()),
    ]
)

SHORT_BAR = T.StructType(
    _BAR_KEY
    + [
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("volatility", T.DoubleType()),
        T.StructField("vwap", T.DoubleType()),
    ]
)

ANOMALY = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("total_volume", T.DoubleType()),
        T.StructField("avg_volume", T.DoubleType()),
        T.StructField("ratio", T.DoubleType()),
        T.StructField("avg_price", T.DoubleType()),
        T.StructField("vwap", T.DoubleType()),
    ]
)

# The envelope's Avro declaration.
ENVELOPE_AVRO = """
{"type": "record", "name": "FinancialData", "namespace": "com.financial", "fields": [
  {"name": "type", "type": "string"},
  {"name": "data", "type": {"type": "array", "items":
    {"type": "record", "name": "TradeData", "fields": [
      {"name": "p", "type": "double"},
      {"name": "s", "type": "string"},
      {"name": "t", "type": "long"},
      {"name": "v", "type": "double"},
      {"name": "c", "type": ["null", {"type": "array", "items": "string"}], "default": null}
    ]}}}
]}
"""



def _without_conditions(avro: str) -> str:
    declared = json.loads(avro)
    item = declared["fields"][1]["type"]["items"]
    item["fields"] = [field for field in item["fields"] if field["name"] != "c"]
    return json.dumps(declared)


# The same record as readers that skip the conditions list declare it.
SLIM_ENVELOPE_AVRO = _without_conditions(ENVELOPE_AVRO)
