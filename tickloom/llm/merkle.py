"""Merkle manifest of a data set, with octopus multiproofs (operator 13).

Every row is a leaf. The leaves of a source, in order of id, form a tree of `FAN` children a node;
the subroots of the sources, in order of source, form another one, whose top is the root. Nodes are
written level by level, with the coordinates (tree, level, index); tree 0 is that of the subroots.

Proofs are made for whole ranges of leaves at a time. A range computes the coordinates of the nodes
that it lacks: the siblings of its leaves and of the interior nodes above them that it can derive
itself, each once. It fetches them in one join, derives the shared interiors, and expands its
leaves' own proofs from them. Only leaves near the ends of a range lack anything, so a range fetches
a few nodes a level however many proofs it expands.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.order import numbered, ranges_of
from tickloom.session import store

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = 0  # the tree of the subroots


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its length in UTF-8 bytes, a colon, itself; "-" for NULL."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(values: Iterable[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def source_key(source: Column) -> Column:
    """A source as a string without NULL, in the same order, NULL first."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def _parents(nodes: DataFrame) -> DataFrame:
    """The next level of trees that have more than one node in this one: tree, level, index, size, digest."""
    return (
        nodes.where("size > 1")
        .groupBy("tree", "level", "size", F.floor(F.col("index") / FAN).cast("long").alias("up"))
        .agg(F.sort_array(F.collect_list(F.struct("index", "digest"))).alias("run"))
        .select(
            "tree",
            (F.col("level") + 1).alias("level"),
            F.col("up").alias("index"),
            F.ceil(F.col("size") / FAN).cast("long").alias("size"),
            F.sha2(F.concat_ws("", F.col("run.digest")), 256).alias("digest"),
        )
    )


def _levels(leaves: DataFrame, largest: int) -> list[DataFrame]:
    """All levels above `leaves`, each stored; the number of rounds is the height of the largest tree."""
    out: list[DataFrame] = []
    while largest > 1:
        out.append(store(_parents(out[-1] if out else leaves), "nodes"))
        largest = -(-largest // FAN)
    return out


class Manifest:
    """The stored tables of a manifest.

    leaves: part, tree, index, size, doc_id, leaf, fold, and the columns asked for in build().
    nodes: tree, level, index, size, digest of all levels of all trees, leaves included.
    trees: key, tree, size. root: a hex digest; None without rows.
    """

    def __init__(self, leaves: DataFrame, nodes: DataFrame, trees: DataFrame, root: str | None):
        self.leaves, self.nodes, self.trees, self.root = leaves, nodes, trees, root


def build(rows: DataFrame, fields: Iterable[str] = FIELDS, id_col: str = "doc_id", source_col: str = "source", fold: Column | None = None) -> Manifest:
    """The manifest of all rows.

    A leaf hashes `fields` in their order. Rows without an id come first in their source; rows of one
    source and id are ordered by their leaves, and equal rows are leaves of their own. `fold` is a
    leaf digest to check against the manifest, the leaf's own by default. Other columns never matter.
    Rows are read once; what follows handles digests only.
    """
    own = leaf_digest([F.col(f"`{f}`") for f in fields])
    leaves = store(
        rows.select(
            source_key(F.col(f"`{source_col}`")).alias("key"),
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            own.alias("leaf"),
            (own if fold is None else fold).alias("fold"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "leaves",
    )
    placed = numbered(leaves, ["key", "doc_id", "leaf", "row"], ranges_of(leaves), "key")
    sizes = store(leaves.groupBy("key").agg(F.count("*").alias("size")), "sizes")
    known = numbered(sizes, ["key"], ranges_of(sizes))
    trees = store(known.select("key", (F.col("index") + 1).alias("tree"), "size"), "trees")
    ordered = store(placed.drop("local", "row").join(trees, "key").drop("key"), "ordered")
    largest = sizes.agg(F.max("size"), F.count("*")).first()
    bottom = ordered.select("tree", F.lit(0).alias("level"), "index", "size", F.col("leaf").alias("digest"))
    below = _levels(bottom, largest[0] or 0)
    subroots = bottom.where("size = 1")
    for level in below:
        subroots = subroots.unionByName(level.where("size = 1"))
    top = store(
        subroots.select(
            F.lit(TOP).cast("long").alias("tree"),
            F.lit(0).alias("level"),
            (F.col("tree") - 1).alias("index"),
            F.lit(largest[1]).cast("long").alias("size"),
            "digest",
        ),
        "subroots",
    )
    above = _levels(top, largest[1])
    nodes = bottom
    for level in [*below, top, *above]:
        nodes = nodes.unionByName(level)
    last = (above[-1] if above else top).first()
    return Manifest(ordered, nodes, trees, last["digest"] if last else None)


def missing(size: int, known: np.ndarray) -> list[np.ndarray]:
    """Per level of a tree of `size` leaves, the least set of nodes that lets all of `known` (distinct
    leaf indexes) be proved: siblings on the way up that are neither known nor derived from known ones."""
    out = []
    while size > 1:
        parents = np.unique(known // FAN)
        children = (parents[:, None] * FAN + np.arange(FAN)).ravel()
        out.append(np.setdiff1d(children[children < size], known, assume_unique=True))
        known, size = parents, -(-size // FAN)
    return out


def requests(leaves: DataFrame, n_trees: int) -> DataFrame:
    """part, tree, level, index: the nodes that each range of leaves lacks, each once."""

    def ask(table: pa.Table) -> pa.Table:
        tree, index, size = (table.column(c).to_numpy() for c in ("tree", "index", "size"))
        found: list[tuple[int, int, np.ndarray]] = []
        own = np.unique(tree)
        for t in own.tolist():
            here = tree == t
            found += [(t, level, i) for level, i in enumerate(missing(int(size[here][0]), np.unique(index[here])))]
        found += [(TOP, level, i) for level, i in enumerate(missing(n_trees, own - 1))]
        count = [len(i) for _, _, i in found]
        columns = {
            "part": np.full(sum(count), table.column("part")[0].as_py(), np.int64),
            "tree": np.repeat(np.array([t for t, _, _ in found], np.int64), count),
            "level": np.repeat(np.array([level for _, level, _ in found], np.int32), count),
            "index": np.concatenate([i for _, _, i in found]).astype(np.int64) if found else np.zeros(0, np.int64),
        }
        return pa.table(columns)

    return leaves.select("part", "tree", "index", "size").groupBy("part").applyInArrow(
        ask, "part long, tree long, level int, index long"
    )


class _Tree:
    """What a range knows of one tree: digests by level and index; siblings' digests on the way up."""

    def __init__(self, size: int):
        self.size = size
        self.levels: list[dict[int, str]] = [{}]
        while size > 1:
            self.levels.append({})
            size = -(-size // FAN)
        self.above: dict[tuple[int, int], list[str]] = {}

    def derive(self) -> str:
        """Fill in the interiors above what is known; returns the top."""
        for level, own in enumerate(self.levels[1:], 1):
            below, size = self.levels[level - 1], self.size
            for _ in range(level - 1):
                size = -(-size // FAN)
            for up in {i // FAN for i in below}:
                run = [below.get(i) for i in range(up * FAN, min(size, up * FAN + FAN))]
                if up not in own and None not in run:
                    own[up] = sha256("".join(run).encode()).hexdigest()
        return self.levels[-1][0]

    def path(self, level: int, index: int) -> list[tuple[str, str]]:
        """Level by level, the digests before and after a node in its run, each joined."""
        if level + 1 == len(self.levels):
            return []
        if (level, index) not in self.above:
            below, start = self.levels[level], index // FAN * FAN
            run = [below[i] for i in range(start, start + FAN) if i in below]
            at = index - start
            self.above[level, index] = [
                ("".join(run[:at]), "".join(run[at + 1 :])), *self.path(level + 1, index // FAN)
            ]
        return self.above[level, index]


def proofs(manifest: Manifest, with_siblings: bool = False) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: a row per leaf of
    `manifest.leaves`, which may be any part of those built.

    proof_sha256 hashes the siblings' digests, level by level up to the root, left to right;
    folded_root is the top that `fold` gives with them. `with_siblings` adds `siblings`: per level, the
    digests before and after the path's own node.
    """
    n_trees = manifest.trees.count()
    leaves = manifest.leaves.select("part", "tree", "index", "size", "doc_id", "leaf", "fold")
    wanted = requests(leaves, n_trees)
    fetched = wanted.join(manifest.nodes.drop("size"), ["tree", "level", "index"]).select("part", "tree", "level", "index", "digest")
    root = manifest.root
    siblings = "array<struct<before: string, after: string>>"
    schema = (
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
        + (f", siblings {siblings}" if with_siblings else "")
    )

    def expand(own: pa.Table, nodes: pa.Table) -> pa.Table:
        trees = {TOP: _Tree(n_trees)}
        leaf_rows = own.to_pylist()
        for r in leaf_rows:
            trees.setdefault(r["tree"], _Tree(r["size"])).levels[0][r["index"]] = r["leaf"]
        for r in nodes.to_pylist():
            trees[r["tree"]].levels[r["level"]][r["index"]] = r["digest"]
        tops = {t: tree.derive() for t, tree in trees.items() if t != TOP}
        for t, digest in tops.items():
            trees[TOP].levels[0][t - 1] = digest
        top = trees[TOP].derive()
        out: list[list] = [[] for _ in range(8)]
        for r in leaf_rows:
            path = trees[r["tree"]].path(0, r["index"]) + trees[TOP].path(0, r["tree"] - 1)
            proof = sha256("".join([x for pair in path for x in pair]).encode()).hexdigest()
            folded = top  # what the range has derived from its own leaves and the siblings fetched
            if r["fold"] != r["leaf"]:
                folded = r["fold"]
                for before, after in path:
                    folded = sha256((before + folded + after).encode()).hexdigest()
            row = (r["doc_id"], r["leaf"], tops[r["tree"]], root, proof, folded, folded == root, path)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        types = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
        made = {n: pa.array(c, t) for n, c, t in zip(names, out, types, strict=False)}
        if with_siblings:
            pair = pa.struct([("before", pa.string()), ("after", pa.string())])
            made["siblings"] = pa.array([[{"before": b, "after": a} for b, a in p] for p in out[7]], pa.list_(pair))
        return pa.table(made)

    return leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(expand, schema)


def tampered_proofs(docs: DataFrame) -> DataFrame:
    """proofs() of `documents`, where every fifth document by checksum of its id is checked with its
    text in lower case (A-Z only) instead of the text that the manifest has."""
    lower = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(F.coalesce(chosen, F.lit(False)), lower).otherwise(F.col("text"))
    fold = leaf_digest([text if f == "text" else F.col(f) for f in FIELDS])
    return proofs(build(docs, fold=fold))
