"""Session settings and the shared folder for stored intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# What a job on this library should run with. Partition counts are left to the cluster:
# AQE coalesces batch shuffles from spark.sql.shuffle.partitions down to the advisory size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

# Window state goes to RocksDB on the executors' disks, so its size is not bound by the
# heap, and each commit uploads a change log instead of a full snapshot.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply SETTINGS to a session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Hold some settings for the duration of a block; a streaming query started inside keeps them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


# What store() has written and nobody has removed yet, per application.
_STORED: dict[str, list[str]] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that all executors share.

    That folder is spark.checkpoint.dir, or else the one given to setCheckpointDir(). There is
    no default: a folder of one machine would lose what other executors look for.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared folder and give back a scan of it.

    For results that are read more than once and are much smaller than what they are
    computed from. Unlike a cache it survives lost executors, and every reader scans only
    the columns it needs. The files stay until remove_stored().
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    _STORED.setdefault(spark.sparkContext.applicationId, []).append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_stored(spark: SparkSession) -> int:
    """Delete what store() has written in this application; returns the number of folders.

    To be called when nothing derived from stored tables is read any more.
    """
    paths = _STORED.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        remove_path(spark, path)
    return len(paths)


def remove_path(spark: SparkSession, path: str) -> None:
    folder, files = hadoop_path(spark, path)
    files.delete(folder, True)


def hadoop_path(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """A path and its file system, for existence checks and clean-up of whatever store it is in."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    folder, files = hadoop_path(spark, path)
    return files.exists(folder)
