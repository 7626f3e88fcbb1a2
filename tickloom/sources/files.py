"""Envelopes kept in files, as tables and as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickloom.schema import ENVELOPE, SLIM_ENVELOPE


def read_envelopes(spark: SparkSession, path: str, conditions: bool = False) -> DataFrame:
    """Parquet envelopes. Without `conditions` their lists are not read from disk: Spark
    does not prune fields inside an exploded array by itself."""
    return spark.read.schema(ENVELOPE if conditions else SLIM_ENVELOPE).parquet(path)


def envelope_files(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    conditions: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """A folder of envelope files (Parquet or JSON lines) as a stream."""
    reader = spark.readStream.format(format).schema(ENVELOPE if conditions else SLIM_ENVELOPE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)
