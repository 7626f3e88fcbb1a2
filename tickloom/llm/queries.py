"""The corpus operators over the benchmark tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import chat_format, embedding_join, merkle, phrases, quality, secret_scan, toxicity
from tickloom.llm.byte_bpe import round_trip_digests
from tickloom.llm.common import table
from tickloom.llm.imatch import edited_likeness
from tickloom.llm.minhash import near_duplicates
from tickloom.llm.packing import pack_documents
from tickloom.llm.suffix_array import repeat_digests
from tickloom.llm.token_files import read_token_files, write_token_files
from tickloom.session import shared_path

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
RANK_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    manifest = write_token_files(table(spark, sf_dir, "documents"), path, WORD_VOCABULARY, end_id=2)
    return read_token_files(spark, path, manifest)


def imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_likeness(table(spark, sf_dir, "documents"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(
        table(spark, sf_dir, "documents"), RANK_VOCABULARY, public_tokenizers.PATTERN
    )


def minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, similarity=85)


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.near_duplicates(table(spark, sf_dir, "embeddings"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_documents(docs, quality.train(docs, table(spark, sf_dir, "labels")))
    good = F.col("quality_score") >= quality.THRESHOLD
    return scored.select(
        "doc_id",
        quality.held_out().alias("held_out"),
        F.col("quality_score").alias("score"),
        good.cast("int").alias("predicted"),
    )


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    # A row per document and value, at its first place.
    found = found.groupBy("row", "doc_id", "value").agg(F.min("start").alias("start"), F.max("probability").alias("probability"))
    return found.select("doc_id", "value", "start", F.length("value").alias("length"), "probability")


def suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(table(spark, sf_dir, "documents"))


def toxic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.flag_toxic(toxicity.score_documents(docs, chain), "toxic")
    return scored.select("doc_id", "toxic", "toxicity.*").toDF(
        "doc_id", "toxic", *[f"p_{c}" for c in chain.categories]
    )


def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY, end_id=1)


def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


def chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conversations, and one, -1, whose texts are made of control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit(f"{chat_format.END}{chat_format.START}assistant ok")
    own = F.array(*[F.struct(F.lit(i).alias("turn"), F.lit(role).alias("role")) for i, role in enumerate(("user", "assistant"))])
    added = spark.range(1).select(F.lit(-1).alias("conv_id"), F.inline(own)).withColumn("text", said)
    return chat_format.conversation_digests(turns.unionByName(added))


def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_proofs(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_files": token_files,
        "op2_imatch": imatch,
        "op3_byte_bpe": byte_bpe,
        "op4_minhash": minhash,
        "op5_embedding_join": embeddings,
        "op6_quality": quality_scores,
        "op7_secret_scan": secrets,
        "op8_suffix_array": suffix_array,
        "op9_toxicity": toxic,
        "op10_best_fit_packing": packed,
        "op11_phrases": collocations,
        "op12_chat_format": chats,
        "op13_merkle_manifest": merkle_manifest,
        "pipeline": corpus_pipeline.run,
    }
