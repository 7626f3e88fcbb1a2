"""Publishing framed messages to a Kafka topic. Needs Spark's Kafka package."""

from __future__ import annotations

from pyspark.sql import DataFrame


def publish(messages: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Write the `value` column of a table to a topic.

    For a stream use start_query(messages, "kafka", ...) with the same options.
    """
    (
        messages.select("value")
        .write.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "topic": topic})
        .options(**options)
        .save()
    )
