"""Operator 13: proofs against a brute-force tree, and the query against its SQL."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest

import __spark_entry__ as driver
from fixtures_llm import SF_DIR
from tickloom.llm import merkle
from test_queries import counted, database

ROWS = "doc_id long, source string, lang string, n_chars long, text string, leaf string, part int"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, change=False):
    row = [*row[:4], row[4] and row[4].translate({c: c + 32 for c in range(65, 91)}) if change else row[4]]
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def climb(nodes, at):
    """The top of a list of digests, and the siblings (before, after) of the node `at`, level by level."""
    path = []
    while len(nodes) > 1:
        run = nodes[at // 16 * 16 : at // 16 * 16 + 16]
        path.append(("".join(run[: at % 16]), "".join(run[at % 16 + 1 :])))
        nodes = [digest("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        at //= 16
    return nodes[0], path


def expected(rows):
    sources: dict = {}
    for row in rows:
        sources.setdefault(row[1], []).append(row)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for own in sources.values():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subroots = [climb([leaf(r) for r in sources[s]], 0)[0] for s in order]
    out = []
    for k, s in enumerate(order):
        for i, row in enumerate(sources[s]):
            root, above = climb(subroots, k)
            path = climb([leaf(r) for r in sources[s]], i)[1] + above
            folded = leaf(row, row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0)
            for before, after in path:
                folded = digest(before + folded + after)
            proof = digest("".join(x for pair in path for x in pair))
            out.append((row[0], leaf(row), subroots[k], root, proof, folded, folded == root))
    return sorted(out, key=repr)


def corpus(n_sources, sizes):
    draw = random.Random(n_sources)
    rows = []
    for k in range(n_sources):
        source = [None, "", "é", "=", "-"][k] if k < 5 else f"s{k}"
        for i in range(sizes[k % len(sizes)]):
            text = draw.choice([None, "", "Some Text É", "lower"]) if i % 3 else f"Document {i} 😀" * 9
            rows.append((1000 * k + i, source, draw.choice([None, "en"]), draw.choice([None, i]), text))
    # Rows without an id, repeated rows, and one id with two texts.
    rows += [(None, None, None, None, None)] * 3 + [(7, "é", "en", 1, "Same")] * 2 + [(7, "é", "en", 1, "Other")]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n_sources", "sizes"), [(1, [1]), (3, [16, 17, 1]), (7, [300, 15, 33]), (20, [2, 5])])
def test_proofs_equal_brute_force(spark, n_sources, sizes):
    rows = corpus(n_sources, sizes)
    table = spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS)
    found = merkle.tampered_proofs(table)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == expected(rows)


def test_one_row_and_none(spark):
    row = (0, "a", "en", 1, "A")
    assert sorted(map(tuple, merkle.tampered_proofs(spark.createDataFrame([(*row, "x", 1)], ROWS)).collect())) == expected([row])
    assert expected([row])[0][2:4] == (leaf(row), leaf(row))
    assert merkle.tampered_proofs(spark.createDataFrame([], ROWS)).collect() == []


def test_a_part_of_the_leaves_is_proved_with_the_same_siblings(spark):
    rows = corpus(7, [300, 15, 33])
    made = merkle.build(spark.createDataFrame([(*r, "x", 1) for r in rows], ROWS))
    whole = merkle.proofs(made, with_siblings=True).where("doc_id % 50 = 0").collect()
    some = merkle.Manifest(made.leaves.where("doc_id % 50 = 0"), made.nodes, made.trees, made.root)
    part = merkle.proofs(some, with_siblings=True).collect()
    assert sorted(map(repr, whole)) == sorted(map(repr, part)) and part
    assert all(r.verified and r.folded_root == r.root for r in part)
    for r in part:
        top = r.leaf
        for before, after in r.siblings:
            top = digest(before + top + after)
        assert top == made.root


def test_only_missing_nodes_are_fetched():
    # Leaves 3 to 40 of 1000: siblings to both sides, and those of the interiors above them.
    levels = merkle.missing(1000, np.arange(3, 41))
    assert [x.tolist() for x in levels] == [[0, 1, 2, *range(41, 48)], list(range(3, 16)), [1, 2, 3]]
    assert merkle.missing(1, np.array([0])) == []
    assert sum(map(len, merkle.missing(5000, np.arange(5000)))) == 0


def test_the_query_equals_its_sql(spark):
    found = driver.queries()["op13_merkle_manifest"](spark, SF_DIR)
    made = database(SF_DIR).sql(driver.oracle_sql()["op13_merkle_manifest"])
    assert counted(found.collect(), found.columns) == counted(made.fetchall(), made.columns)
