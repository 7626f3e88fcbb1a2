"""The pipeline, stage by stage, against brute force."""

import re

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from fixtures_llm import SF_DIR
from test_llm_near import linked_groups
from test_llm_repeats import removed
from tickloom.session import store


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after each stage."""
    out = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(store(stage(spark, out[-1], SF_DIR), "stage"))
    return out


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_stages_keep_the_columns_and_follow_each_other(stages):
    for docs in stages[:5]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        assert docs.where("n_chars <> length(text)").count() == 0
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_good_documents_stay_and_bad_ones_go(spark, stages):
    kept = texts(stages[1])
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    assert sum((r.doc_id in kept) == (r.quality == 1) for r in labels) >= 0.97 * len(labels)


def test_one_of_each_group_stays(stages):
    before = texts(stages[1])
    groups = linked_groups(list(before.items()), 5, 80)
    assert set(texts(stages[2])) == {i for i in before if groups.find(i) == i}


def test_repeats_are_cut(stages):
    before, after = texts(stages[2]), texts(stages[3])
    for key, raw, mask in removed(list(before.items()), 100):
        kept = bytes(b for b, gone in zip(raw, mask, strict=True) if not gone)
        assert after[key] == kept.decode("utf-8", "ignore")


def test_secrets_are_redacted(stages):
    secret = r'AKIA[A-Z0-9]{16}|(?<=password=)[0-9a-f]{16,}|(?<=token = ")[0-9a-f]{16,}'
    before, after = texts(stages[3]), texts(stages[4])
    assert after == {i: re.sub(secret, "[secret]", t) for i, t in before.items()}


def test_everything_is_packed(stages):
    pieces = stages[5].collect()
    assert {r.doc_id for r in pieces} == set(texts(stages[4]))
    sums = {}
    for r in pieces:
        sums[r.sequence_id] = sums.get(r.sequence_id, 0) + r.length
    assert max(sums.values()) <= 4096


def test_the_query_runs_all_stages(spark, stages):
    found = driver.queries()["pipeline"](spark, SF_DIR)
    assert found.drop("sequence_id", "offset").exceptAll(stages[5].drop("sequence_id", "offset")).count() == 0
    assert found.count() == stages[5].count()
