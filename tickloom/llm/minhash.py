"""Near duplicates by b-bit MinHash (operator 4).

Of each set of word shingles, `bands * rows` minima are taken under as many hash functions. A
band's minima, hashed together, are the keys under which candidates meet; of each minimum only the
lowest 4 bits are kept and packed. The similarity of two documents is estimated by counting equal
nibbles, corrected for those equal by chance, and candidates far below the threshold are dropped
unseen. The others are confirmed on their full sets.

Work is done per class of equal sets, so exact copies are one row. Within a bucket of candidates,
not all pairs are made: first each member is compared with the bucket's smallest document only,
which joins most of what belongs together. Members of a bucket that then lie in different
components are compared with each other, in blocks of bounded size, by longer packed signatures
that only they have; each pair in one bucket of those it shares. The members that may be linked to
another meet again in the same blocks, now with their full sets, and are decided on the spot: pairs
that earlier links of the block have joined are passed over, and only links that join two components
leave the block. So pairs are never rows, and the components are those of all links between candidates.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import keyed_text, mix, runs, seeds
from tickloom.llm.components import connected_components
from tickloom.llm.shingles import shingle_set
from tickloom.session import settings, store

WORDS = 5
SIMILARITY = 80  # percent
BANDS, ROWS = 24, 4
BITS = 4
PER_LONG = 64 // BITS
ERRORS = 4.5  # standard errors that an estimate may lie below the threshold
WIDE = 384  # minima of the longer signatures
BLOCK = 1500  # members of a block's side
BLOCK_SHINGLES = 3_000_000  # of a block's side, about
_FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}


def fingerprint(own: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    if not len(own):
        return 0, 0
    sums = [int(mix(own ^ s).sum(dtype=np.uint64)) for s in seeds(2, 5)]
    return tuple(s - (1 << 64) if s >> 63 else s for s in sums)


class Sketcher:
    def __init__(self, bands: int, rows: int):
        self.shape = bands, rows
        count = bands * rows
        if count % PER_LONG:
            raise ValueError(f"bands * rows must be a multiple of {PER_LONG}")
        self.factors = seeds(count, 17)
        self.salts = mix(np.arange(1, bands + 1, dtype=np.uint64))
        self.shifts = (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))[None, :]

    def sketch(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Band keys, and the packed low bits of the minima, both as 64-bit integers."""
        least = np.full(len(self.factors), np.uint64(2**64 - 1))
        for at in range(0, len(own), 512):
            np.minimum(least, (own[at : at + 512, None] * self.factors).min(axis=0), out=least)
        least = mix(least)
        keys = self.salts.copy()
        for column in least.reshape(self.shape).T:
            keys = mix(keys ^ column)
        low = (least & np.uint64((1 << BITS) - 1)).reshape(-1, PER_LONG)
        return keys.view(np.int64), np.bitwise_or.reduce(low << self.shifts, axis=1).view(np.int64)


def sketches(rows: DataFrame, words: int, bands: int, per_band: int) -> DataFrame:
    """doc_id, n_shingles, set_hi, set_lo, keys, packed for keyed_text rows."""

    def sketch(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(bands, per_band)
        longs = pa.list_(pa.int64())
        for part in parts:
            for at in range(0, part.num_rows, 1024):
                some = part.slice(at, 1024)
                out: list[list] = [[], [], [], [], []]
                for text in some.column(1).to_pylist():
                    own = shingle_set(text, words)
                    keys, packed = maker.sketch(own) if len(own) else (None, None)
                    for column, value in zip(out, (len(own), *fingerprint(own), keys, packed), strict=True):
                        column.append(value)
                types = [pa.int64(), pa.int64(), pa.int64(), longs, longs]
                arrays = [pa.array(c, t) for c, t in zip(out, types, strict=True)]
                names = ["doc_id", "n_shingles", "set_hi", "set_lo", "keys", "packed"]
                yield pa.RecordBatch.from_arrays([some.column(0), *arrays], names=names)

    return rows.mapInArrow(
        sketch,
        "doc_id long, n_shingles long, set_hi long, set_lo long, keys array<long>, packed array<long>",
    )


def estimate(a: Column, b: Column, count: int) -> Column:
    """Similarity from packed signatures, corrected for values that agree by chance."""

    def unequal(x: Column) -> Column:
        x = x["a"].bitwiseXOR(x["b"])
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    pairs = F.arrays_zip(a.alias("a"), b.alias("b"))
    differ = F.aggregate(F.transform(pairs, unequal), F.lit(0), lambda s, x: s + x)
    chance = 1 / (1 << BITS)
    return (1 - differ / count - chance) / (1 - chance)


def least_estimate(similarity: int, count: int) -> float:
    """What a linked pair's estimate falls short of only by ERRORS standard errors."""
    chance = 1 / (1 << BITS)
    same = similarity / 100 * (1 - chance) + chance
    return similarity / 100 - ERRORS * float(np.sqrt(same * (1 - same) / count)) / (1 - chance)


def _sizes_fit(similarity: int) -> Column:
    return 100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b")


def confirmed(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (a, b) that are linked, by their full sets (rep, shingles)."""

    def confirm(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            a, b, first, second = part.columns
            keep = []
            for x, y in zip(first, second, strict=True):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= similarity * (len(x) + len(y) - both))
            kept = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(kept), b.filter(kept)], names=["a", "b"])

    rows = (
        pairs.join(sets.select(F.col("rep").alias("b"), F.col("shingles").alias("second")), "b")
        .join(sets.select(F.col("rep").alias("a"), F.col("shingles").alias("first")), "a")
        .select("a", "b", "first", "second")
    )
    return rows.mapInArrow(confirm, "a long, b long")


def _candidates(found: dict[str, np.ndarray], key: int, low: float, similarity: int) -> Iterator[tuple[int, np.ndarray]]:
    """Of one block of the bucket `key`: each member with the later ones that it may be linked to, in
    other components, unless an earlier band brings the two together."""
    side = found["side"]  # 1 and 2 are compared with each other; 0 with itself
    rows, columns = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
    if not len(rows):
        rows = columns = np.flatnonzero(side == 0)
    wide, keys, n, comp, rep = (found[k] for k in ("wide", "keys", "n", "component", "rep"))
    chance, count = 1 / (1 << BITS), wide.shape[1] * PER_LONG
    for i in rows.tolist():
        other = columns[(comp[columns] != comp[i]) & ((rep[columns] > rep[i]) | (side[i] != 0))]
        small, large = np.minimum(n[other], n[i]), np.maximum(n[other], n[i])
        other = other[100 * small >= similarity * large]
        if not len(other):
            continue
        other = other[keys[i][(keys[other] == keys[i]).argmax(axis=1)] == key]
        x = (wide[other] ^ wide[i]).view(np.uint64)
        for shift in (1, 2):
            x |= x >> np.uint64(shift)
        differ = np.bitwise_count(x & np.uint64(0x1111111111111111)).sum(axis=1)
        other = other[(1 - differ / count - chance) / (1 - chance) >= low]
        if len(other):
            yield i, other


def _forest(
    found: dict[str, np.ndarray], sets: list[np.ndarray], key: int, low: float, similarity: int
) -> tuple[list[int], list[int]]:
    """Of one block: links between full sets that join its components, as many as it takes."""
    # Sets as places in the block's list of shingles; a member's own are marked, its partners' counted.
    known, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum([len(own) for own in sets])])
    marked = np.zeros(len(known), bool)
    n, rep = found["n"], found["rep"]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    first, second = [], []
    for i, other in _candidates(found, key, low, similarity):
        own, others = root(int(found["component"][i])), [root(c) for c in found["component"][other].tolist()]
        other = other[np.array(others) != own]
        mine = flat[starts[i] : starts[i + 1]]
        marked[mine] = True
        for at in range(0, len(other), 256):
            some = other[at : at + 256]
            places = np.concatenate([flat[starts[k] : starts[k + 1]] for k in some])
            edges = np.concatenate([[0], np.cumsum(n[some])[:-1]])
            both = np.add.reduceat(marked[places].astype(np.int64), edges)
            for k in some[100 * both >= similarity * (n[some] + n[i] - both)].tolist():
                a, b = root(int(found["component"][i])), root(int(found["component"][k]))
                if a != b:
                    parent[a] = b
                    first.append(int(min(rep[i], rep[k])))
                    second.append(int(max(rep[i], rep[k])))
        marked[mine] = False
    return first, second


def _blocks(members: DataFrame, labels: DataFrame) -> DataFrame:
    """key, i, j, m, rep, component, side: the members of buckets with several components, in blocks.

    A bucket's largest component is compared with the rest, the rest with each other, in blocks of
    at most about BLOCK members and BLOCK_SHINGLES shingles a side.
    """
    known = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select(
        "key", "rep", "n", F.coalesce("component", "rep").alias("component")
    )
    sizes = known.groupBy("key", "component").agg(F.count("*").alias("n"), F.sum("n").alias("shingles"))

    def blocks_of(count: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(count / BLOCK), F.ceil(shingles / BLOCK_SHINGLES))

    buckets = (
        sizes.groupBy("key")
        .agg(
            F.max(F.struct("n", "component", "shingles")).alias("top"),
            F.sum("n").alias("all"),
            F.sum("shingles").alias("weight"),
            F.count("*").alias("kinds"),
        )
        .where("kinds > 1")
        .select(
            "key",
            F.col("top.component").alias("main"),
            blocks_of(F.col("top.n"), F.col("top.shingles")).alias("main_blocks"),
            blocks_of(F.col("all") - F.col("top.n"), F.col("weight") - F.col("top.shingles")).alias("rest_blocks"),
        )
    )
    slot = F.xxhash64("rep", "key")
    rest = F.pmod(slot, "rest_blocks")
    main_side = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1),
        lambda i: F.struct(i.alias("i"), F.pmod(slot, "main_blocks").alias("j"), F.lit(True).alias("m"), F.lit(2).alias("side")),
    )
    rest_side = F.concat(
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("main_blocks") - 1),
            lambda j: F.struct(rest.alias("i"), j.alias("j"), F.lit(True).alias("m"), F.lit(1).alias("side")),
        ),
        F.transform(
            F.sequence(F.lit(0).cast("long"), F.col("rest_blocks") - 1),
            lambda j: F.struct(
                F.least(rest, j).alias("i"),
                F.greatest(rest, j).alias("j"),
                F.lit(False).alias("m"),
                F.when(rest == j, 0).when(rest < j, 1).otherwise(2).alias("side"),
            ),
        ),
    )
    placed = F.inline(F.when(F.col("component") == F.col("main"), main_side).otherwise(rest_side))
    return known.join(buckets, "key").select("key", "rep", "component", placed)


_PLACE = ["key", "i", "j", "m"]


def _in_blocks(rows: DataFrame, act: Callable, schema: str) -> DataFrame:
    """What `act` makes of each block: of (key, arrays by column, rows as an Arrow table)."""

    def run(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in runs(parts, tuple(_PLACE)):
            found = {k: block.column(k).to_numpy() for k in ("rep", "component", "side", "n")}
            for name in ("keys", "wide"):
                found[name] = np.stack(block.column(name).to_numpy())
            made = act(block.column("key")[0].as_py(), found, block)
            if made is not None and made.num_rows:
                yield from made.to_batches()

    return rows.repartition(*_PLACE).sortWithinPartitions(*_PLACE).mapInArrow(run, schema)


def _crossing(members: DataFrame, sets: DataFrame, labels: DataFrame, low: float, similarity: int) -> DataFrame:
    """Links (a, b) between members that meet in a bucket and lie in different components: enough to join
    all that are linked."""

    def may_link(key: int, found: dict[str, np.ndarray], block: pa.Table) -> pa.Table:
        meets = np.zeros(block.num_rows, bool)
        for i, other in _candidates(found, key, low, similarity):
            meets[i] = meets[other] = True
        return block.filter(pa.array(meets)).select([*_PLACE, "rep", "component", "side"])

    def decide(key: int, found: dict[str, np.ndarray], block: pa.Table) -> pa.Table:
        own = [np.frombuffer(v.as_buffer(), np.uint64) for v in block.column("shingles")]
        a, b = _forest(found, own, key, low, similarity)
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    spark, signs = members.sparkSession, ["rep", "n", "keys", "wide"]
    blocks = _blocks(members, labels).join(sets.select(*signs), "rep").select(*_PLACE, "component", "side", *signs)
    place = "key long, i long, j long, m boolean, rep long, component long, side int"
    near = store(_in_blocks(blocks, may_link, place), "meeting")
    whole = near.join(sets.select(*signs, "shingles"), "rep").select(*_PLACE, "component", "side", *signs, "shingles")
    with settings(spark, _FEW_ROWS):
        return store(_in_blocks(whole, decide, "a long, b long"), "links")


def near_duplicates(
    docs: DataFrame,
    words: int = WORDS,
    similarity: int = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per document.

    Documents are linked if 100 * intersection >= similarity * union of their shingle sets.
    component_id is the smallest doc_id reachable, and the document that has it is kept. A text
    without words (NULL and empty ones) is linked with nothing. A row without an id keeps NULL as
    its component and is kept. Rows with the same id and different texts are told apart by their
    sets; each has its own component. Empty tables give no rows.

    A linked pair at the threshold meets in none of the bands with probability
    (1 - s**rows)**bands, 3e-6 for 0.8 and 2e-8 for 0.85 by default.
    """
    texts = keyed_text(docs, id_col, text_col)
    count = bands * rows
    low = least_estimate(similarity, count)
    sketched = store(sketches(texts, words, bands, rows), "sketches")
    identity = ["set_hi", "set_lo", "n_shingles"]
    classes = store(
        sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
        .groupBy(*identity)
        .agg(F.min("doc_id").alias("rep"), F.any_value("keys").alias("keys"), F.any_value("packed").alias("packed")),
        "classes",
    )
    # A document with several sets could stand for several classes; they are one node then.
    signatures = classes.select("rep", F.col("n_shingles").alias("n"), "packed", "set_hi", "set_lo")
    members = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    hubs = members.groupBy("key").agg(F.min("rep").alias("hub"), F.count("*").alias("met")).where("met > 1").drop("met")
    # Members of buckets that have several, with the bucket's smallest document.
    met = store(members.join(hubs, "key"), "met")
    pairs = met.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    side = signatures.select("rep", "n", "packed")
    candidates = (
        pairs.join(side.toDF("a", "n_a", "packed_a"), "a")
        .join(side.toDF("b", "n_b", "packed_b"), "b")
        .where(_sizes_fit(similarity) & (estimate(F.col("packed_a"), F.col("packed_b"), count) >= low))
        .select("a", "b")
    )
    active = classes.join(met.select("rep").distinct(), "rep").select(
        F.col("rep").alias("doc_id"), F.col("set_hi").alias("hi"), F.col("set_lo").alias("lo"), "keys"
    )

    def sets_of(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Sketcher(1, WIDE)
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                keep, out = [], []
                for row, (text, hi, lo) in enumerate(zip(*(some.column(i).to_pylist() for i in (4, 1, 2)), strict=True)):
                    own = shingle_set(text, words)
                    if fingerprint(own) == (hi, lo):
                        keep.append(row)
                        out.append((len(own), maker.sketch(own)[1], own.tobytes()))
                if not out:
                    continue
                kept = some.take(pa.array(keep))
                types = [pa.int64(), pa.list_(pa.int64()), pa.binary()]
                columns = [pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [kept.column(0), kept.column(3), *columns], names=["rep", "keys", "n", "wide", "shingles"]
                )

    chosen = texts.join(active, "doc_id").select("doc_id", "hi", "lo", "keys", "text")
    # A repeated row repeats its set; that makes links twice, which does no harm.
    with settings(docs.sparkSession, _FEW_ROWS):
        sets = store(
            chosen.mapInArrow(sets_of, "rep long, keys array<long>, n long, wide array<long>, shingles binary"), "sets"
        )
    # Rows of pairs hold two whole sets, so few of them go to Python at a time.
    with settings(docs.sparkSession, _FEW_ROWS):
        links = store(confirmed(candidates, sets, similarity), "links")
    labels = connected_components(links)
    more = _crossing(met.select("key", "rep", "n"), sets, labels, least_estimate(similarity, WIDE), similarity)
    if more.limit(1).count():
        labels = connected_components(links.union(more))
    of_class = classes.select(*identity, "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return (
        sketched.select("doc_id", *identity)
        .join(of_class.select(*identity, "rep", "component"), identity, "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
        )
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that near_duplicates() keeps: one of each component, and all without an id.

    Rows that share an id are one document: it stays if any of its texts is kept.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **options)
    gone = (
        found.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").alias("_gone"))
        .agg(F.bool_or("kept").alias("stays"))
        .where("NOT stays")
    )
    return docs.join(gone, docs[id_col].cast("long") == gone["_gone"], "left_anti")
