"""From raw documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept and is written as Parquet before the next one reads it.
All but the last return the columns of `documents`; where a stage changes a text, n_chars follows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import minhash, packing, quality, secret_scan, suffix_array
from tickloom.llm.common import table
from tickloom.session import store

END_ID = 1


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; it learns from the labelled ones among docs."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates by word shingles, the document with the smallest id stays."""
    return minhash.drop_near_duplicates(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 100 bytes and more that occur earlier are cut out."""
    return _counted(suffix_array.remove_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; the documents stay."""
    return _counted(secret_scan.redact(docs, secret_scan.scan(docs)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 4096 ids: a row per piece of a document."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [
    ("quality classifier", keep_good),
    ("minhash near-dedup", drop_copies),
    ("suffix-array dedup", cut_repeats),
    ("secret scans", redact_secrets),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs


# SQL can express neither the classifiers nor the packing; tests compare with brute force.
ORACLE_SQL = None
