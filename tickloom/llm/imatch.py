"""I-Match fingerprints over randomised lexicons (operator 2).

A term is a lower-cased run of letters and digits, known by a hash of 64 bits. The lexicon holds
the terms whose document frequency lies in a band: rare ones are typing errors and names,
frequent ones say nothing. Frequencies are counted exactly over all documents, and the tasks get
the sorted hashes of the lexicon's terms: 8 bytes each, so as much as the vocabulary in the band.

From the lexicon, randomised subsets are drawn: a subset keeps a term if a hash of both falls
below the subset's share. A document's terms in the lexicon are made distinct, and one hash is
taken over those in each subset. The shares range over several scales, since a subset
tells near copies apart only if it keeps about one term of the changed part: short texts are
described by the large subsets, long ones by the small subsets. There are as many scales as the
text with most distinct terms needs.

Where the band leaves no term of a text or hardly any (as if more than its largest share are
copies or near copies of it), the subsets are taken of all its terms. Such a fallback is marked: its hashes are even, others are odd.
It is compared with the hashes over all terms of the other text, whatever that one has.

Likeness of two fingerprints: among the subsets of one share that keep a term of either document,
the part whose hashes agree, at the share where that is most; 1 for equal fingerprints, but 0 for
different texts of which no subset keeps a term. DOUBT
subsets that disagree are added to each share, since a share of which one subset keeps a term says
little. A share
far too large for a text never agrees after an edit, one far too small keeps nothing.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tickloom.llm.common import keyed_text, mix, seeds

BITS = 64  # of a term's hash
DRAW_BITS = 22  # of them that decide which subsets keep a term
BAND = (2, 0.02)  # fewest documents; largest share of all documents
SHARES = (1 / 2, 1 / 8, 1 / 32, 1 / 128, 1 / 512, 1 / 2048)  # the first ones; see shares_for()
SUBSETS_PER_SHARE = 10
DOUBT = 2
THIN = 1 / 16  # of a text's terms: with fewer in the band, all its terms count
ROWS_PER_PARTITION = 4000
_WORDS_KEPT = 400_000
_TERM = re.compile(r"[^\W_]+")
_HASHES: dict[str, int] = {}


def terms(text: str, bits: int) -> np.ndarray:
    """The distinct terms of a text in ascending order of their hash."""
    if len(_HASHES) > _WORDS_KEPT:
        _HASHES.clear()
    known, out = _HASHES, set()
    for word in set(_TERM.findall(text.lower())):
        number = known.get(word)
        if number is None:
            known[word] = number = xxhash.xxh3_64_intdigest(word)
        out.add(number >> (64 - bits))
    found = np.fromiter(out, np.uint64, len(out))
    found.sort()
    return found


def band_terms(rows: DataFrame, bits: int = BITS, band: tuple[int, float] = BAND) -> tuple[np.ndarray, int]:
    """The terms in the band, ascending, and the most distinct terms of a text, from keyed_text rows.

    Each task counts before the shuffle. The kept terms come to the driver in blobs.
    """

    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, most = [], 0, 0

        def flush():
            own, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(own), 1 << 16):
                some = own[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(some.view(np.int64)), pa.array(n[at : at + (1 << 16)]), pa.array([most] * len(some), pa.int64())],
                    names=["term", "n", "most"],
                )

        def empty():
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int64())] * 2 + [pa.array([most], pa.int64())], names=["term", "n", "most"])

        for part in parts:
            for text in part.column(0).to_pylist():
                own = terms(text, bits)
                held.append(own)
                size, most = size + len(own), max(most, len(own))
                if size > 4_000_000:
                    yield from flush()
                    held, size = [], 0
        # A task without terms gives a row that counts for nothing, as empty results are not observed.
        yield from flush() if size else empty()

    def pack(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            blob = part.column(0).to_numpy(zero_copy_only=False).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["blob"])

    total = rows.count()
    if not total:
        return np.zeros(0, np.uint64), 0
    seen = Observation()
    counted = (
        rows.select("text")
        .mapInArrow(count, "term long, n long, most long")
        .observe(seen, F.max("most").alias("most"))
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    largest = max(band[0], int(band[1] * total))
    blobs = counted.where(F.col("n").between(max(1, band[0]), largest)).select("term").mapInArrow(pack, "blob binary").collect()
    kept = np.frombuffer(b"".join(bytes(r[0]) for r in blobs), np.uint64)
    return np.sort(kept), int(seen.get.get("most") or 0)


def lexicon(rows: DataFrame, bits: int, band: tuple[int, float] = BAND) -> bytes:
    """The terms in the band as a bitmap of 2**bits places, for few bits."""
    kept, _ = band_terms(rows, bits, band)
    found = np.zeros(max(1, (1 << bits) // 64), np.uint64)
    np.bitwise_or.at(found, kept >> np.uint64(6), np.uint64(1) << (kept & np.uint64(63)))
    return found.tobytes()


def shares_for(most: int) -> tuple[float, ...]:
    """SHARES, and further ones until the smallest keeps about one of `most` terms."""
    shares = list(SHARES)
    while shares[-1] * most > 1:
        shares.append(shares[-1] / 4)
    return tuple(shares)


class Fingerprinter:
    """fingerprint(text): an array with a hash per subset, 0 where the subset keeps no term."""

    def __init__(self, kept: np.ndarray, bits: int, shares: tuple[float, ...], per_share: int, seed: int):
        self.bits = bits
        self.kept = kept
        self.cut = np.uint64(max(0, bits - DRAW_BITS))
        self.seeds = seeds(len(shares) * per_share, seed)
        below = np.repeat(np.array(shares), per_share) * 2.0**64
        self.below = np.minimum(below, 2.0**64 - 4096).astype(np.uint64)

    def fingerprint(self, text: str) -> np.ndarray:
        """Over the terms in the band, or else over all terms."""
        found = terms(text, self.bits)
        at = np.searchsorted(self.kept, found)
        known = at < len(self.kept)
        known[known] = self.kept[at[known]] == found[known]
        if known.sum() >= THIN * len(found):
            own = self._hashes(found[known], np.uint64(1))
            if own.any():
                return own
        return self._hashes(found, np.uint64(0))

    def fallback(self, text: str) -> np.ndarray:
        """Over all terms of a text."""
        return self._hashes(terms(text, self.bits), np.uint64(0))

    def near(self, text: str, own: np.ndarray, other_text: str, other: np.ndarray, per_share: int) -> float:
        """The likeness of two texts by their fingerprints."""
        if _is_fallback(own) != _is_fallback(other):
            own, other = self.fallback(text), self.fallback(other_text)
        return likeness(own, other, per_share, text == other_text)

    def _hashes(self, found: np.ndarray, mark: np.uint64) -> np.ndarray:
        out, some = np.zeros(len(self.seeds), np.uint64), np.zeros(len(self.seeds), bool)
        # In blocks, so that a very long text needs little memory. The hash of a subset is made
        # from the sum of its terms' scrambled numbers; 0 stands for no term. The leading bits decide
        # whether it keeps a term, all bits tell terms apart.
        for at in range(0, len(found), 1024):
            some_terms = found[at : at + 1024]
            own = mix((some_terms >> self.cut) + np.uint64(1))[:, None] * self.seeds
            keeps = own < self.below
            own ^= own >> np.uint64(31)
            own *= np.uint64(0xD6E8FEB86659FD93)
            own += mix(some_terms)[:, None]
            out += np.where(keeps, own, np.uint64(0)).sum(axis=0, dtype=np.uint64)
            some |= keeps.any(axis=0)
        return np.where(some, (mix(out) | np.uint64(3)) ^ (np.uint64(1) - mark), np.uint64(0))


def _is_fallback(fingerprint: np.ndarray) -> bool:
    return not (fingerprint & np.uint64(1)).any()


def likeness(a: np.ndarray, b: np.ndarray, per_share: int = SUBSETS_PER_SHARE, same_text: bool = False) -> float:
    if np.array_equal(a, b):
        return float(same_text or bool(a.any()))
    either = ((a != 0) | (b != 0)).reshape(-1, per_share)
    same = (a == b).reshape(-1, per_share) & either
    return float((same.sum(axis=1) / (DOUBT + either.sum(axis=1))).max())


def _text_of(fingerprint: np.ndarray) -> str:
    return fingerprint.astype(">u8").tobytes().hex()


def fingerprints(
    docs: DataFrame,
    bits: int = BITS,
    band: tuple[int, float] = BAND,
    shares: tuple[float, ...] | None = None,
    per_share: int = SUBSETS_PER_SHARE,
    seed: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id and fingerprint (hexadecimal) of every text; a text without terms, NULL and
    empty ones among them, has the fingerprint of zeros."""
    rows = keyed_text(docs, id_col, text_col)
    kept, most = band_terms(rows, bits, band)
    shares = shares or shares_for(most)
    sent = rows.sparkSession.sparkContext.broadcast(kept)

    def make(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(sent.value, bits, shares, per_share, seed)
        for part in parts:
            texts = [_text_of(maker.fingerprint(t)) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts)], names=["doc_id", "fingerprint"])

    return rows.mapInArrow(make, "doc_id long, fingerprint string")


def edited_likeness(
    docs: DataFrame,
    bits: int = BITS,
    band: tuple[int, float] = BAND,
    shares: tuple[float, ...] | None = None,
    per_share: int = SUBSETS_PER_SHARE,
    seed: int = 1,
    rows_per_partition: int = ROWS_PER_PARTITION,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """How fingerprints follow an edit of half the text: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 2) characters replaced by the first as many (or
    all) of the next document in descending order of doc_id; the first follows the last. NULL ids
    come last and rows with equal ids are ordered by text. An empty table gives no rows, a single
    document follows itself.

    Texts are dealt into ranges of ids whose bounds are ids of the table, so the document that
    follows a range is known by its id, and a copy of it is sent along. Nothing needs a window
    over the whole table.
    """
    rows = keyed_text(docs, id_col, text_col)
    total = rows.count()
    kept, most_terms = band_terms(rows, bits, band)
    shares = shares or shares_for(most_terms)
    sent = rows.sparkSession.sparkContext.broadcast(kept)
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63)))
    most = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(most, -(-total // rows_per_partition)))
    marks = rows.agg(
        F.percentile_approx(key, [i / parts for i in range(1, parts + 1)], 100 * parts).alias("inner"),
        F.max(key).alias("last"),
    ).first()
    bounds = sorted({*marks["inner"], marks["last"]}) if total else []
    # Range i ends with bound i, so the document behind range i + 1, read downwards, has that id;
    # behind range 0 comes the highest id of all, the last bound.
    place = F.lit(0)
    if bounds:
        place = F.array_size(F.filter(F.lit(bounds), lambda b: b < F.col("key")))
    last = len(bounds) - 1
    at = F.array_position(F.lit(bounds or [0]), F.col("key"))
    also = F.when(at == last + 1, F.lit(0)).when(at > 0, at.cast("int"))
    dealt = (
        rows.withColumn("key", key)
        .withColumn("place", place.cast("int"))
        .withColumn("also", also)
        .select(
            "doc_id",
            "text",
            "key",
            F.inline(
                F.array_compact(
                    F.array(
                        F.struct(F.col("place"), F.lit(False).alias("copy")),
                        F.when(F.col("also").isNotNull(), F.struct(F.col("also").alias("place"), F.lit(True).alias("copy"))),
                    )
                )
            ),
        )
        .repartition(max(1, len(bounds)), "place")
        .sortWithinPartitions("place", "copy", F.desc("key"), "text")
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(sent.value, bits, shares, per_share, seed)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        waiting, done = None, -1

        def compared(doc, own, nxt, other):
            text, half = doc[1], len(doc[1]) // 2
            edited = text[: len(text) - half] + nxt[1][:half]
            print_edited = own if edited == text else maker.fingerprint(edited)
            sha = hashlib.sha256(edited.encode("utf-8")).hexdigest()
            return (
                doc[0], len(text), sha, _text_of(own), _text_of(print_edited),
                maker.near(text, own, edited, print_edited, per_share), maker.near(text, own, nxt[1], other, per_share),
            )

        for batch in batches:
            out = []
            for doc_id, text, place, copy in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 3)), strict=True):
                if place == done:
                    continue  # further rows with the id of the bound: only the first follows
                own = maker.fingerprint(text)
                if waiting is not None:
                    out.append(compared(waiting[0], waiting[1], (doc_id, text), own))
                waiting = ((doc_id, text), own)
                if copy:
                    waiting, done = None, place
            if out:
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return dealt.select("doc_id", "text", "place", "copy").mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )
