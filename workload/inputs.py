"""Trades and envelopes derived from the benchmark tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schema import TRADE_ITEM
from tickloom.session import configure

# Trades per envelope. Event ids are unique, so this bounds every collected list.
ENVELOPE_SIZE = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _volume() -> Column:
    return F.get_json_object("props", "$.k").cast("double")


def _as_trades(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("value").alias("price"),
        _volume().alias("volume"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


def event_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trades: type is the symbol, value the price, props.k the volume."""
    return _as_trades(table(spark, sf_dir, "events"))


def event_trade_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trades as a stream over the event files."""
    schema = table(spark, sf_dir, "events").schema
    # A pattern, since a file stream takes folders and patterns but no single file.
    return _as_trades(spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]"))


def line_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trades of the part's brand, at the unit price, on the shipping day.

    No broadcast hint: parts grow with the data. Spark broadcasts them while they are below
    its size limit and otherwise runs a sort-merge join, in which AQE splits a busy part.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_brand").alias("symbol"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        F.col("l_quantity").alias("volume"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
    )


def event_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events packed into envelopes; errors arrive as 'ping' envelopes, the rest as 'trade'."""
    item = F.struct(
        F.col("value").alias("p"),
        F.col("event_type").alias("s"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("t"),
        _volume().alias("v"),
        F.lit(None).cast(TRADE_ITEM["c"].dataType).alias("c"),
    )
    kind = F.when(F.col("event_type") == "error", "ping").otherwise("trade")
    number = F.floor(F.col("event_id") / ENVELOPE_SIZE)
    return (
        table(spark, sf_dir, "events")
        .groupBy(number.alias("number"), kind.alias("type"))
        .agg(F.collect_list(item).alias("data"))
    )


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to 4 digits and timestamps without zone.

    Sums of doubles depend on their order in the last bits. The small offset keeps exact
    halves, which means of cents often are, away from the rounding boundary.
    """

    def plain(field: T.StructField) -> Column:
        column = F.col(field.name)
        if field.dataType == T.DoubleType():
            column = F.round(column + 1e-7, 4)
        elif field.dataType == T.TimestampType():
            column = column.cast("timestamp_ntz")
        return column.alias(field.name)

    return df.select(*[plain(field) for field in df.schema.fields])
