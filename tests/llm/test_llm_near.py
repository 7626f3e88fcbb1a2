"""Operators 2, 4 and 5: fingerprints and near duplicates, against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from fixtures_llm import SF_DIR, awkward, documents, words
from tickloom.llm import embedding_join, imatch, minhash, queries
from tickloom.llm.components import connected_components
from tickloom.llm.shingles import shingle_set, word_hashes


class Groups:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def find(self, n):
        while self.parent[n] != n:
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.parent[b] = a


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(202, 201), (201, 200), (200, 202), (7, 7)]
    table = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.component for r in connected_components(table).collect()}
    assert found == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200, 202: 200}
    assert connected_components(table.where("a < 0")).count() == 0


# Operator 2


def test_edits_follow_the_next_document_downwards(spark):
    rows = [r for r in awkward() if r != (None, None)]
    found = imatch.edited_likeness(documents(spark, rows), bits=12, band=(1, 1.0), rows_per_partition=3).collect()
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else -1), r[1] or ""))
    expected = []
    for i, (key, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        expected.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted((tuple(r)[:3] for r in found), key=repr) == sorted(expected, key=repr)
    prints = {}
    for (_, text), r in zip(order, sorted(found, key=lambda r: 0), strict=True):
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    by_sha = imatch.fingerprints(documents(spark, rows), bits=12, band=(1, 1.0)).collect()
    for r in by_sha:
        prints.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert len(prints[7]) == 1 and prints[9] <= prints[8]


def test_one_document_and_none(spark):
    [row] = imatch.edited_likeness(documents(spark, [(3, "abcd")])).collect()
    assert (row.n_chars, row.edited_sha256) == (4, hashlib.sha256(b"abab").hexdigest())
    assert imatch.edited_likeness(documents(spark, [])).count() == 0


def test_an_edited_text_is_nearer_than_another(spark):
    draw = random.Random(4)
    rows = [(i, words(draw, 120, 900)) for i in range(60)]
    found = imatch.edited_likeness(documents(spark, rows), band=(2, 0.5)).collect()
    assert np.mean([r.near_edited > r.near_next for r in found]) > 0.9
    assert np.mean([r.near_next for r in found]) < 0.1


def test_the_band_leaves_rare_and_frequent_terms_out(spark):
    rows = documents(spark, [(i, f"all some{i % 3} only{i}") for i in range(30)])
    bitmap = np.frombuffer(imatch.lexicon(rows.select("doc_id", "text"), 16, (2, 0.5)), np.uint64)
    held = {w for w in ["all", "some0", "some1", "some2", *[f"only{i}" for i in range(30)]]
            for t in imatch.terms(w, 16) if bitmap[t >> 6] >> np.uint64(t & 63) & np.uint64(1)}
    assert {"some0", "some1", "some2"} <= held and "all" not in held and len(held) <= 5


# Operator 4


def sets_of(text, n):
    own = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not own:
        return frozenset()
    n = min(n, len(own))
    return frozenset(tuple(own[i : i + n]) for i in range(len(own) - n + 1))


def linked_groups(rows, n, similarity):
    sets = [(i, sets_of(t, n)) for i, t in rows if i is not None]
    groups = Groups({i for i, _ in sets})
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                groups.join(i, j)
    return groups


def near_copies(draw, groups=6, size=9):
    rows = []
    for _ in range(groups):
        text = words(draw, draw.choice([5, 40, 150])).split()
        for _ in range(size):
            copy = list(text)
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                copy[draw.randrange(len(copy))] = f"new{draw.randrange(999)}"
            rows.append(" ".join(copy))
    rows += [words(draw, 50) for _ in range(20)]
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("n, similarity", [(3, 85), (5, 80), (1, 60)])
def test_near_duplicates_are_those_of_brute_force(spark, monkeypatch, n, similarity):
    rows = near_copies(random.Random(n))
    groups = linked_groups(rows, n, similarity)
    found = minhash.near_duplicates(documents(spark, rows), words=n, similarity=similarity).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.n_shingles == len(sets_of(rows[r.doc_id][1], n))
        assert r.component_id == groups.find(r.doc_id) and r.kept == (r.component_id == r.doc_id)


def test_members_of_a_bucket_meet_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 3)
    rows = near_copies(random.Random(8), groups=3, size=25)
    groups = linked_groups(rows, 3, 90)
    found = minhash.near_duplicates(documents(spark, rows), words=3, similarity=90).collect()
    assert all(r.component_id == groups.find(r.doc_id) for r in found)


def test_awkward_documents_are_told_apart(spark):
    found = minhash.near_duplicates(documents(spark, awkward()), words=3, similarity=85).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id, r.kept))
    assert by[2] == [(0, 2, True)] and by[1] == [(0, 1, True)] and by[3] == [(0, 3, True)]
    assert by[None] == [(0, None, True), (1, None, True)] or sorted(by[None]) == [(0, None, True), (1, None, True)]
    assert [x[1:] for x in by[9]] == [(8, False)] and {x[1] for x in by[8]} == {8}
    assert by[7] == [(1, 7, True)] * 2
    kept = minhash.drop_near_duplicates(documents(spark, awkward()), words=3, similarity=85)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(i or 0 for i, _ in awkward() if i != 9)
    assert kept.columns == documents(spark, []).columns
    assert minhash.near_duplicates(documents(spark, [])).count() == 0


def test_word_hashes_know_only_ascii_case_and_blanks():
    same = word_hashes("One\x0btwo THREE".encode())
    assert (same == word_hashes(b"one two three")).all()
    assert len(set(word_hashes("É é a b ab ba".encode()))) == 5
    assert len(shingle_set("a b", 3)) == 1 and len(shingle_set(" ", 3)) == 0


def test_estimate_is_near_the_similarity():
    draw = random.Random(2)
    text = words(draw, 400).split()
    other = [w if draw.random() > 0.05 else "x" + w for w in text]
    a, b = (shingle_set(" ".join(t), 1) for t in (text, other))
    true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    maker = minhash.Sketcher(24, 4)
    x = maker.sketch(a)[1].view(np.uint64) ^ maker.sketch(b)[1].view(np.uint64)
    for shift in (1, 2):
        x |= x >> np.uint64(shift)
    differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum()
    assert abs((1 - differ / 96 - 1 / 16) / (15 / 16) - true) < 0.15


# Operator 5


def vector_groups(vectors, cosine):
    vectors = [v and None not in v and (np.array(v) / (np.abs(v).max() or 1)).tolist() for v in vectors]
    good = [i for i, v in enumerate(vectors) if v and np.isfinite(v).all() and any(v)]
    groups, links = Groups(range(len(vectors))), [0] * len(vectors)
    for k, i in enumerate(good):
        for j in good[:k]:
            a, b = np.array(vectors[i]), np.array(vectors[j])
            if len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    return groups, links


@pytest.mark.parametrize("dims, blocks, chunk", [(16, 4, 12000), (16, 4, 7), (3, 4, 12000), (1, 4, 5)])
def test_vectors_link_as_by_brute_force(spark, dims, blocks, chunk):
    draw = np.random.default_rng(dims + chunk)
    vectors = []
    for _ in range(12):
        centre = draw.normal(size=dims)
        vectors += [(centre + draw.normal(size=dims) * 0.18).tolist() for _ in range(8)]
    vectors += [vectors[0]] * 5 + [[-x for x in vectors[1]], [1e200 * x for x in vectors[2]], [x * 1e-200 for x in vectors[3]]]
    vectors += [None, [], [0.0] * dims, [float("nan")] * dims, [float("inf")] + [1.0] * (dims - 1), [None] * dims, [1.0] * (dims + 1)]
    groups, links = vector_groups(vectors, 0.9)
    table = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>").selectExpr("*", "1 AS links", "2 AS code")
    found = embedding_join.near_duplicates(table, blocks=blocks, chunk=chunk).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == [
        (i, links[i], groups.find(i), groups.find(i) == i) for i in range(len(vectors))
    ]


def test_vectors_without_id_and_without_rows(spark):
    table = spark.createDataFrame([(None, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01])], "vec_id long, embedding array<float>")
    found = sorted(map(tuple, embedding_join.near_duplicates(table).collect()), key=repr)
    assert found == [(1, 1, 1, True), (2, 1, 1, False), (None, 0, None, True)]
    assert embedding_join.near_duplicates(table.where("vec_id > 9")).count() == 0


def test_queries_over_whole_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    groups = linked_groups(docs, 3, 85)
    for r in queries.queries()["op4_minhash"](spark, SF_DIR).collect():
        assert r.component_id == groups.find(r.doc_id)
    rows = sorted(spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect(), key=lambda r: r.vec_id)
    ids = [r.vec_id for r in rows]
    groups, links = vector_groups([[float(x) for x in r.embedding] for r in rows], 0.9)
    found = {r.vec_id: (r.n_links, r.component_id) for r in queries.queries()["op5_embedding_join"](spark, SF_DIR).collect()}
    assert found == {ids[i]: (links[i], ids[groups.find(i)]) for i in range(len(ids))}


def test_large_groups_around_the_threshold_are_decided_in_blocks(spark, monkeypatch):
    # One base text; each document changes some words, so that pairs lie on both sides of the threshold.
    draw = random.Random(12)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        own = list(base)
        for at in draw.sample(range(120), draw.choice([1, 2, 3, 4, 5])):
            own[at] = f"x{draw.randrange(400)}"
        rows.append((i, " ".join(own)))
    groups = linked_groups(rows, 3, 85)
    expected = {i: groups.find(i) for i, _ in rows}
    assert 3 < len(set(expected.values())) < 150
    for block, shingles in ((1500, 3_000_000), (7, 3_000_000), (1500, 1000)):
        monkeypatch.setattr(minhash, "BLOCK", block)
        monkeypatch.setattr(minhash, "BLOCK_SHINGLES", shingles)
        found = minhash.near_duplicates(documents(spark, rows), words=3, similarity=85).collect()
        assert {r.doc_id: r.component_id for r in found} == expected
