"""Near duplicates of embeddings by a subspace pigeonhole join (operator 5).

Vectors are scaled to length 1, so a cosine of `cosine` or more is a squared distance of at most
2 - 2 * cosine. They are rotated and split into blocks, and each block gets a share of that squared
distance in proportion to its dimensions. If two vectors are within the whole, they are within the
share in one block at least. So each block is range-joined: on a grid over its first two
dimensions, whose cells are as wide as the block's radius, a vector meets those of its own and of
the neighbouring cells. The pairs within a block's share are checked exactly on the whole vectors.
A pair is counted in the first block that has it within its share, so blocks need no common
deduplication.

Equal vectors are one row. Crowded cells are split into chunks that are joined pairwise, so no task
holds more than two chunks. A task hands on, for each vector, the number of its links, and of the
links only a spanning forest, which is what the components need.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import runs
from tickloom.llm.components import connected_components
from tickloom.session import store

COSINE = 0.9
BLOCKS = 4
CHUNK = 12_000
_TILE = 512
_NEIGHBOURS = ((0, 1), (1, -1), (1, 0), (1, 1))  # half of them: the other half looks back


def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation: it spreads a difference evenly over the blocks."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def block_bounds(dims: int, blocks: int) -> list[tuple[int, int]]:
    """Non-empty blocks of nearly equal width."""
    edges = [dims * i // blocks for i in range(blocks + 1)]
    return [(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a]


def shares(dims: int, blocks: int, cosine: float) -> np.ndarray:
    """The squared distance granted to each block, with a margin for rounding."""
    widths = np.array([b - a for a, b in block_bounds(dims, blocks)], float)
    return (2 - 2 * cosine) * widths / dims * (1 + 1e-9) + 1e-12


def _units(raw: list[bytes], dims: int) -> np.ndarray:
    vectors = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), dims)
    # Scaled by the largest entry first, so that squares neither overflow nor vanish.
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def _classes(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id and the vector as bytes of doubles; NULL where it can be linked with nothing."""

    def read(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[bytes | None] = []
            for vector in part.column(1).to_pylist():
                own = None
                if vector and None not in vector:
                    values = np.array(vector, "<f8") + 0.0  # turns -0.0 into 0.0
                    if np.isfinite(values).all() and values.any():
                        own = values.tobytes()
                out.append(own)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.binary())], names=["vec_id", "raw"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(read, "vec_id long, raw binary")


def _cells(classes: DataFrame, blocks: int, cosine: float) -> DataFrame:
    """Each class with its grid cell in each block."""

    def place(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("block", pa.int64()), ("x", pa.int64()), ("y", pa.int64())]))
        for part in parts:
            raw, cells = part.column("raw").to_pylist(), []
            for one in raw:
                dims = len(one) // 8
                turned = _units([one], dims)[0] @ _rotation(dims)
                radius = np.sqrt(shares(dims, blocks, cosine))
                cells.append(
                    [
                        {"block": k, "x": int(np.floor(turned[a] / radius[k])), "y": int(np.floor(turned[min(a + 1, b - 1)] / radius[k]))}
                        for k, (a, b) in enumerate(block_bounds(dims, blocks))
                    ]
                )
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cells, kind)], names=[*part.schema.names, "cells"])

    return classes.mapInArrow(
        place, "rep long, code long, copies long, raw binary, cells array<struct<block: long, x: long, y: long>>"
    )


_ROTATIONS: dict[int, np.ndarray] = {}


def _rotation(dims: int) -> np.ndarray:
    if dims not in _ROTATIONS:
        _ROTATIONS[dims] = rotation(dims)
    return _ROTATIONS[dims]


class _Forest:
    """Components of a task's vectors; join() returns the edges that connect new ones."""

    def __init__(self, count: int):
        self.root = np.arange(count)

    def join(self, i: int, others: np.ndarray) -> list[tuple[int, int]]:
        roots = np.unique(self.root[others])
        roots = roots[roots != self.root[i]]
        edges = []
        for r in roots.tolist():
            edges.append((i, int(others[np.argmax(self.root[others] == r)])))
        if len(roots):
            self.root[np.isin(self.root, roots)] = self.root[i]
        return edges


def join_block(
    units: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool, block: int, blocks: int, cosine: float,
    copies: np.ndarray,
) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Links between two lists of rows that `block` is the first to have within its share.

    Returns each row's number of links (copies counted) and a spanning forest of the links.
    """
    dims = units.shape[1]
    turned = units @ _rotation(dims)
    bounds, share = block_bounds(dims, blocks), shares(dims, blocks, cosine)
    low, high = bounds[block]
    own = turned[:, low:high]
    square = (own * own).sum(axis=1)
    links, forest, edges = np.zeros(len(units), np.int64), _Forest(len(units)), []
    for at in range(0, len(left), _TILE):
        rows = left[at : at + _TILE]
        near = square[rows][:, None] + square[right][None, :] - 2 * own[rows] @ own[right].T <= share[block] + 1e-9
        if same:
            near &= np.arange(len(right))[None, :] > np.arange(at, at + len(rows))[:, None]
        i, j = np.nonzero(near)
        for part in range(0, len(i), 200_000):
            a, b = rows[i[part : part + 200_000]], right[j[part : part + 200_000]]
            # The same differences in any task and order, so exactly one block counts a pair.
            first = np.ones(len(a), bool)
            for k, (p, q) in enumerate(bounds[: block + 1]):
                within = ((turned[a, p:q] - turned[b, p:q]) ** 2).sum(axis=1) <= share[k]
                first &= within if k == block else ~within
            a, b = a[first], b[first]
            linked = (units[a] * units[b]).sum(axis=1) >= cosine
            a, b = a[linked], b[linked]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            cuts = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else []
            for low_at, group in zip(cuts, np.split(b, cuts[1:]) if len(a) else [], strict=True):
                edges += forest.join(int(a[low_at]), group)
    return links, edges


def near_duplicates(
    vectors: DataFrame,
    cosine: float = COSINE,
    blocks: int = BLOCKS,
    chunk: int = CHUNK,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row per vector.

    Vectors are linked if their cosine, in double precision, is at least `cosine` (above -1).
    NULL and empty vectors, zero ones, and those with NULL or non-finite entries link with nothing,
    as do vectors of different lengths with each other. A row without an id has no links, NULL as
    its component, and is kept. Rows with the same id have each their links and are one node for
    the components. Empty tables give no rows.
    """
    read = store(_classes(vectors, id_col, vector_col), "vectors")
    # Classes of equal vectors; `code` tells classes with the same smallest id apart.
    grouped = (
        read.where("raw IS NOT NULL AND vec_id IS NOT NULL")
        .groupBy("raw")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
        .select("rep", F.xxhash64("raw").alias("code"), "copies", "raw")
    )
    placed = store(_cells(grouped, blocks, cosine), "cells")
    cell = ["dims", "block", "x", "y"]
    homes = placed.select(
        F.floor(F.length("raw") / 8).alias("dims"), "rep", "code", "copies", F.inline("cells")
    )
    around = F.array(
        F.struct(F.col("x"), F.col("y"), F.lit(False).alias("guest")),
        *[
            F.struct((F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"), F.lit(True).alias("guest"))
            for dx, dy in _NEIGHBOURS
        ],
    )
    spots = homes.select("dims", "block", "rep", "code", "copies", F.inline(around))
    sizes = (
        spots.groupBy(*cell)
        .agg(F.count_if(~F.col("guest")).alias("own"), F.count_if("guest").alias("guests"))
        .where("own > 0 AND own + guests > 1")
        .select(
            *cell,
            F.ceil(F.col("own") / chunk).alias("own_chunks"),
            F.ceil(F.col("guests") / chunk).alias("guest_chunks"),
        )
    )
    slot = F.xxhash64("rep", "code", "block")
    mine, theirs = F.pmod(slot, "own_chunks"), F.pmod(slot, F.greatest("guest_chunks", F.lit(1)))

    def upto(n: str):
        return F.when(F.col(n) > 0, F.sequence(F.lit(0).cast("long"), F.col(n) - 1)).otherwise(F.array().cast("array<bigint>"))

    def task(i, j, cross: bool, side):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(cross).alias("cross"), side.alias("side"))

    as_own = F.concat(
        F.transform(
            upto("own_chunks"),
            lambda k: task(F.least(mine, k), F.greatest(mine, k), False, F.when(mine == k, 0).when(mine < k, 1).otherwise(2)),
        ),
        F.transform(upto("guest_chunks"), lambda k: task(mine, k, True, F.lit(1))),
    )
    as_guest = F.transform(upto("own_chunks"), lambda k: task(k, theirs, True, F.lit(2)))
    keys = [*cell, "i", "j", "cross"]
    tasks = (
        spots.join(sizes, cell)
        .select(*cell, "rep", "code", "copies", F.inline(F.when(F.col("guest"), as_guest).otherwise(as_own)))
        .join(placed.select("rep", "code", "raw"), ["rep", "code"])
        .select(*keys, "side", "rep", "code", "copies", "raw")
    )

    def compare(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(parts, tuple(keys)):
            side = rows.column("side").to_numpy()
            dims, block = rows.column("dims")[0].as_py(), rows.column("block")[0].as_py()
            left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
            same = not len(left)
            if same:
                left = right = np.flatnonzero(side == 0)
            if not len(left) or not len(right) or len(side) < 2:
                continue
            units = _units(rows.column("raw").to_pylist(), dims)
            rep, code = rows.column("rep").to_numpy(), rows.column("code").to_numpy()
            links, edges = join_block(
                units, left, right, same, block, blocks, cosine, rows.column("copies").to_numpy()
            )
            some = np.flatnonzero(links)
            if len(some):
                none = np.zeros(len(some), np.int64)
                columns = [rep[some], code[some], links[some], none]
                if edges:
                    a, b = np.array(edges).T
                    zero = np.zeros(len(edges), np.int64)
                    columns = [np.concatenate(c) for c in zip(columns, (rep[a], zero, zero, rep[b]), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["rep", "code", "links", "other"])

    dealt = tasks.repartition(*keys).sortWithinPartitions(*keys)
    found = store(dealt.mapInArrow(compare, "rep long, code long, links long, other long"), "links")
    counts = found.where("links > 0").groupBy("rep", "code").agg(F.sum("links").alias("links"))
    labels = connected_components(found.where("links = 0").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    of_class = (
        placed.select("rep", "code", "copies", "raw")
        .join(counts, ["rep", "code"], "left")
        .join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        .select("raw", "rep", "copies", "links", "component")
    )
    component = F.coalesce("component", "rep", "vec_id")
    known = F.col("vec_id").isNotNull()
    return read.join(of_class, "raw", "left").select(
        "vec_id",
        F.when(known & F.col("rep").isNotNull(), F.coalesce("links", F.lit(0)) + F.col("copies") - 1)
        .otherwise(0)
        .alias("n_links"),
        F.when(known, component).alias("component_id"),
        (~known | (F.col("vec_id") == component)).alias("kept"),
    )
