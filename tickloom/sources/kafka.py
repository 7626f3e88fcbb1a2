"""Kafka topics as streams and as bounded tables. Needs Spark's Kafka package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "latest",
    max_offsets: int | None = None,
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """A topic as a stream; `starting` counts only for a query without a checkpoint.

    `max_offsets` bounds the records per micro-batch. `min_partitions` splits the topic's
    partitions further, so that a topic with few of them still decodes on all cores.
    """
    reader = spark.readStream.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**options).load()


def kafka_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    min_partitions: int | None = None,
    **options: str,
) -> DataFrame:
    """What a topic holds now, as a table, for inspection."""
    reader = spark.read.format("kafka").options(
        **{
            "kafka.bootstrap.servers": servers,
            "subscribe": topic,
            "startingOffsets": starting,
            "endingOffsets": ending,
        }
    )
    if min_partitions is not None:
        reader = reader.option("minPartitions", min_partitions)
    return reader.options(**options).load()
