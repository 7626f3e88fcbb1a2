"""Operator 11: phrases against brute force, the counting kernels, and the query against its SQL."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as driver
from fixtures_llm import SF_DIR, awkward
from tickloom.llm import phrases
from test_queries import counted, database

ROWS = "doc_id long, lang string, text string, phrase string, chunk int, f int"


def occurrences(rows, longest):
    """By language, how often each phrase of up to `longest` words occurs."""
    found: dict = {}
    for lang, text in rows:
        own = found.setdefault("und" if lang is None else lang, Counter())
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            for n in range(1, longest + 1):
                own.update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    return found


def expected(rows, least, longest, top, share):
    out = []
    for lang, f in occurrences(rows, longest).items():
        n = sum(k for p, k in f.items() if len(p) == 1)
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        dropped = set()
        for p, a in candidates.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner = p[i : i + m]
                    if 100 * a >= share * candidates[inner]:
                        dropped.add(inner)
        kept = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, left, right = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def corpus(seed, n, vocabulary):
    draw = random.Random(seed)
    fixed = ["New York City hall", "É é 漢字 \x1c x", "a a a a a", "to be or not", "x"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(draw.randrange(30)):
            if draw.random() < 0.3:
                parts.append(draw.choice(fixed))
            else:
                parts.append(f"w{int(draw.paretovariate(0.7)) % vocabulary}")
            parts.append(draw.choice([" ", " ", " ", "\t ", ", ", ".", "\n", " ?", "\x0b"]))
        rows.append((draw.choice(["en", "en", "en", None, "", "und"]), "".join(parts)))
    return rows


def found(spark, rows, **options):
    table = spark.createDataFrame([(i, *r, "p", 1, 2) for i, r in enumerate(rows)], ROWS)
    return sorted(map(tuple, phrases.collocations(table, **options).collect()))


@pytest.mark.parametrize(("longest", "least", "top", "chunk"), [(3, 10, 2000, 400_000), (2, 3, 7, 50), (5, 3, 40, 300)])
def test_phrases_equal_brute_force(spark, longest, least, top, chunk):
    rows = corpus(longest, 400, 60)
    made = found(spark, rows, least=least, longest=longest, top=top, chunk_words=chunk)
    assert made == expected(rows, least, longest, top, 50) and len(made) > 10


def test_awkward_texts(spark):
    rows = [(None, t) for _, t in awkward()] * 3 + [("en", None), ("en", ""), ("en", "no phrase at all here")]
    made = found(spark, rows, least=3, top=100)
    assert made == expected(rows, 3, 3, 100, 50) and made
    assert found(spark, rows[-3:]) == [] and found(spark, []) == []


def test_large_counts_are_exact(spark):
    a = 10**15 - 1
    rows = spark.createDataFrame([("en", a, a, a + 7)], "lang string, a long, l long, r long")
    made = rows.select(phrases.score_of("a", "l", "r").alias("score")).first()
    assert made.score == 1000000 * a * a // (a * (a + 7))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**31 - 2) | st.integers(0, 30), st.integers(0, 2**31 - 2) | st.integers(0, 30)), max_size=80), st.integers(1, 3))
def test_tiles_count_like_a_counter(pairs, times):
    codes = np.array([(r << 32) | c for r, c in pairs] * times, np.uint64)
    before = phrases.DENSE
    try:
        for phrases.DENSE in (2, before):
            made, counts = phrases.count_codes(codes)
            assert dict(zip(made.tolist(), counts.tolist(), strict=True)) == Counter(codes.tolist())
            assert made.tolist() == sorted(made.tolist())
    finally:
        phrases.DENSE = before
    assert phrases.unpack_codes(phrases.pack_codes(made)).tolist() == made.tolist()
    twice = phrases.add_up(np.concatenate([made, made]), np.concatenate([counts, counts]))
    assert dict(zip(*map(np.ndarray.tolist, twice), strict=True)) == {c: 2 * n for c, n in Counter(codes.tolist()).items()}


def test_chunks_end_with_pieces():
    batch = pa.RecordBatch.from_arrays([pa.array(["en", "fr"]), pa.array(["a b. c d e\nf " * 50, "x"])], names=["lang", "text"])

    class Context:
        @staticmethod
        def get():
            return Context

        @staticmethod
        def partitionId():
            return 3

    before, phrases.TaskContext = phrases.TaskContext, Context
    try:
        made = [r.to_pylist()[0] for r in phrases._chunks(20)([batch])]
    finally:
        phrases.TaskContext = before
    assert len({r["chunk"] for r in made}) == len(made) > 5
    text = []
    for r in made:
        words = ["\n", *r["words"]]
        text += [words[i] for i in phrases.unpack(r["ids"], np.int32)] if r["lang"] == "en" else []
    assert " ".join(text).split("\n")[:3] == ["a b ", " c d e ", " f a b "]


def test_the_query_equals_its_sql(spark):
    made = driver.queries()["op11_phrases"](spark, SF_DIR)
    told = database(SF_DIR).sql(driver.oracle_sql()["op11_phrases"])
    assert counted(made.collect(), made.columns) == counted(told.fetchall(), told.columns)
