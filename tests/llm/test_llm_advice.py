"""Findings of the second review: each test fails on the code before it."""

import random

import numpy as np
import pytest

from fixtures_llm import documents, words
from tickloom.llm import imatch, quality, secret_scan, toxicity


def mixed(spark, draw, n=600, rare=10):
    """Documents of which one in `rare` is labelled 1, on overlapping evidence."""
    rows, labels = [], []
    for i in range(n):
        one = i % rare == 0
        told = draw.random() < (0.7 if one else 0.3)
        rows.append((i, words(draw, 20) + (" !!! grumble" if told else " plain.")))
        labels.append((i, int(one)))
    return documents(spark, rows), spark.createDataFrame(labels, "doc_id long, label int")


def test_a_score_means_the_same_whatever_the_sample(spark):
    docs, labels = mixed(spark, random.Random(2))
    # All 600 are drawn, or as many of each class: 96 at most.
    means = []
    for sample in (2000, 96):
        model = quality.train(docs, labels, "label", sample=sample)
        means.append(np.mean([r[0] for r in quality.score_documents(docs, model).select("quality_score").collect()]))
    assert means == pytest.approx([0.1, 0.1], abs=0.06)
    means = []
    for sample in (2000, 100):
        chain = toxicity.train(docs, labels, "label", sample=sample)
        means.append(np.mean([r[0] for r in toxicity.score_documents(docs, chain).select("toxicity.label").collect()]))
    assert means == pytest.approx([0.1, 0.1], abs=0.06)


def test_the_forest_knows_the_mix_of_all_findings(spark):
    rows = [(f"v{i}", float(i % 10 == 0), *[0.5] * len(secret_scan.FEATURES)) for i in range(1000)]
    table = spark.createDataFrame(rows, ["value", "label", *secret_scan.FEATURES])
    model = secret_scan.train(table, sample=200)
    judged = secret_scan.judge(table, model)
    assert np.mean([r[0] for r in judged.select("probability").collect()]) == pytest.approx(0.1, abs=0.05)


def test_text_without_white_space_is_judged_by_all_of_it():
    draw = random.Random(4)

    def unspaced(good):
        # The same beginning; bad ones have their marks only in the last half.
        start = "".join(f"{draw.choice(['漢字', '文章', '言葉'])}，" for _ in range(30))
        return start + "".join(f"語{'。' if good else '！？'}" for _ in range(10))

    good = np.arange(200) // 2 % 2 == 0
    found = [quality.features(unspaced(g)) for g in good]
    model = quality.fit(found[:100], good[:100], quality.BITS)
    assert [model.score(f) > 0.5 for f in found[100:]] == good[100:].tolist()
    assert quality.shape("a1" * 40 + "!") != quality.shape("a1" * 40 + "?")


def test_terms_are_counted_one_by_one(spark):
    # 300,000 terms that occur once, and one that occurs twice: a table of 2**22 places has some
    # 10,000 places that several of them share.
    rows = [(i, " ".join(f"t{i}x{k}" for k in range(3000)) + (" twice" if i < 2 else "")) for i in range(100)]
    kept, most = imatch.band_terms(documents(spark, rows).select("doc_id", "text"))
    assert kept.tolist() == imatch.terms("twice", imatch.BITS).tolist() and most == 3001


def test_texts_outside_the_band_have_fingerprints_of_all_their_terms(spark):
    draw = random.Random(9)
    one, two = words(draw, 80, 900), words(draw, 80, 900).upper().replace("W", "V")
    # Two hot groups of unlike texts, ids in turn, and a near copy of the first one.
    rows = [(i, (one, two)[i % 2]) for i in range(40)] + [(100, one.rsplit(" ", 1)[0] + " typo"), (101, one), (-1, "***"), (-2, "+++")]
    found = {r.doc_id: r for r in imatch.edited_likeness(documents(spark, rows)).collect()}
    assert found[5].fingerprint != found[4].fingerprint and found[5].near_next == 0
    assert found[4].fingerprint == found[6].fingerprint and int(found[4].fingerprint, 16)
    assert 0.3 < found[101].near_next < 1
    assert found[-1].near_next == 0  # neither has a term


def test_long_texts_keep_their_likeness_after_an_edit(spark):
    draw = random.Random(1)
    vocabulary = [f"v{k}" for k in range(60_000)]
    rows = [(i, " ".join(draw.sample(vocabulary, 40_000))) for i in range(4)]
    found = imatch.edited_likeness(documents(spark, rows), band=(1, 1.0)).collect()
    assert np.mean([r.near_edited for r in found]) > 0.2
    assert imatch.shares_for(2000) == imatch.SHARES and imatch.shares_for(30_000)[-1] == 1 / 32768


def test_every_place_is_judged_and_values_with_symbols_are_candidates(spark):
    hexed = "0123456789abcdef" * 2
    texts = [
        f"commit {hexed} was bad 😀, so x{hexed} and api_key = \"{hexed}\"",
        "db_password_production=Winter2024! and postgres://me:pa55$word@host/db",
        " ".join(f"{i:020d}" for i in range(300)),
    ]
    found = secret_scan.findings(documents(spark, list(enumerate(texts)))).collect()
    for r in found:
        assert texts[r.doc_id][r.start - 1 : r.start - 1 + len(r.value)] == r.value
        assert texts[r.doc_id][: r.start - 1].endswith(r.before)
    assert [r.value for r in found if r.doc_id == 0] == [hexed, f"x{hexed}", hexed]
    assert {"Winter2024!", "pa55$word"} <= {r.value for r in found if r.doc_id == 1}
    assert len([r for r in found if r.doc_id == 2]) == 300
    secrets = secret_scan.scan(documents(spark, list(enumerate(texts)))).collect()
    assert len([r for r in secrets if r.doc_id == 0 and r.value == hexed]) == 2
