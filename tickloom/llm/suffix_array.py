"""Removal of repeated passages by a distributed sort of suffixes (operator 8).

A byte goes if some `width`-byte string that covers it also starts earlier: in a document with a
smaller id, or further ahead in the same one. Strings are judged on the input.

Not all suffixes are sorted. Of each window of `width` bytes, the position whose `gram` bytes have
the smallest hash is an anchor (all such positions, if several do). The choice depends on the
window's content alone, so equal windows have their anchors at the same place, and comparing the
surroundings of anchors finds every repeat. About one position in 35 is an anchor.

1. Anchors are counted by their hash; those that occur once can be in no repeat.
2. For the others, the suffix from the anchor on (and, for the order among equal ones, the bytes
   before it) is taken from the text. Each task sorts its suffixes, and equal ones stay as the
   earliest: the windows of the later ones are repeats. The sorted run is cut by the range of the
   leading hash, front-coded, and exchanged.
3. A task merges the runs of its range with a loser tree that keeps, for each run, the length of
   the prefix it shares with the last output, so bytes known to be equal are not compared again.
   In the merged order equal suffixes are neighbours, as are all suffixes that share an anchor.
   Where one anchor has several surroundings, their windows are compared one by one.
4. The windows of an anchor that occurs very often are halved by the place of the anchor in them:
   one half shares so many bytes after the anchor, the other so many before it. The hash of those
   shared bytes is the leading hash of the half, so equal windows still meet, and unlike ones go to
   different ranges. A half whose surroundings are still many is halved again in another exchange,
   down to single windows, of which each task holds but one.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import mix, runs, seeds
from tickloom.llm.shingles import _powers
from tickloom.session import remove_path, settings, shared_path, store

WIDTH = 100
GRAM = 32
SLOT_BYTES = 8_000_000
# Ranges of hashes per slot: several in a partition even out, and each is small in memory.
RANGES_PER_SLOT = 2
OFTEN = 4000
# Suffixes that a task holds before it writes them as a run.
HELD = 50_000
# Whole texts and lists are large rows: few of them go to Python at a time.
_FEW_ROWS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "500"}
_OF_BYTE = seeds(256, 202)


def _slide(x: np.ndarray, width: int, op: Callable) -> np.ndarray:
    """op over each run of `width` neighbours."""
    size = 1
    while size * 2 <= width:
        x = op(x[:-size], x[size:])
        size *= 2
    rest = width - size
    return op(x[:-rest], x[rest:]) if rest else x


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    up, _ = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up, out=total[1:])
    return total


def anchors(data: np.ndarray, ends: np.ndarray, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors in documents that lie one behind the other."""
    n, reach = len(data), width - gram + 1
    if n < width:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = _prefix_sums(data)
    _, down = _powers(n)
    hashes = mix((total[gram:] - total[:-gram]) * down[: n - gram + 1])
    least = _slide(hashes, reach, np.minimum)
    # Windows that cross from one document into the next select nothing.
    starts = np.arange(n - width + 1)
    crossing = np.searchsorted(ends, starts, side="right")
    least[starts + width > ends[crossing]] = 0
    padded = np.concatenate([np.zeros(reach - 1, np.uint64), least, np.zeros(reach - 1, np.uint64)])
    at = np.flatnonzero(_slide(padded, reach, np.maximum) == hashes)
    # Anchors have small hashes. Scrambled once more, they are spread evenly over all ranges.
    return at, mix(hashes[at])


def _pack(*columns: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def _unpack(blobs: list[bytes], *types: str) -> list[np.ndarray]:
    """The columns that _pack put into each blob, all blobs one behind the other."""
    width = sum(np.dtype(t).itemsize for t in types)
    parts: list[list[np.ndarray]] = [[] for _ in types]
    for blob in blobs:
        count, at = len(blob) // width, 0
        for part, kind in zip(parts, types, strict=True):
            part.append(np.frombuffer(blob, kind, count, at))
            at += count * np.dtype(kind).itemsize
    return [np.concatenate(p) if p else np.zeros(0, t) for p, t in zip(parts, types, strict=True)]


def _by(part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Blobs of the rows of each part."""
    order = np.argsort(part, kind="stable")
    kinds, first = np.unique(part[order], return_index=True)
    for kind, rows in zip(kinds.tolist(), np.split(order, first[1:]), strict=True):
        yield kind, _pack(*(c[rows] for c in columns))


def _slots(uids: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each document number; _slot_of() is the same as a column."""
    own, back = np.unique(uids, return_inverse=True)
    return np.array([zlib.crc32(b"%d" % u) % slots for u in own.tolist()], np.int64)[back]


def _slot_of(uid: str, slots: int) -> Column:
    return F.pmod(F.crc32(F.col(uid).cast("string")), F.lit(slots))


def _lists(kind: int, rows: Iterable[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * len(rows), pa.int64()),
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([r[1] for r in rows], pa.binary()),
        ],
        names=["kind", "part", "blob"],
    )


_LISTS = "kind long, part long, blob binary"
_EMPTY = pa.schema([("kind", pa.int64()), ("part", pa.int64()), ("blob", pa.binary())])
RUN, SPANS = 0, 1


def _repeated_anchors(rows: DataFrame, slots: int, width: int, gram: int, often: int) -> DataFrame:
    """(slot, blob of uid, position, hash, whether it occurs over `often` times) of anchors whose
    hash occurs more than once."""

    def find(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        count = 0

        def flush():
            hashes, uids, at = (np.concatenate(c) for c in zip(*held, strict=True))
            ranges = np.uint64(slots * RANGES_PER_SLOT)
            part = (hashes >> np.uint64(32)) * ranges >> np.uint64(32)
            return _lists(RUN, _by(part.astype(np.int64), hashes, uids, at))

        for part in parts:
            for own_uids, data, ends in _joined(part):
                at, hashes = anchors(data, ends, width, gram)
                doc = np.searchsorted(ends, at, side="right")
                starts = np.concatenate([[0], ends[:-1]])
                held.append((hashes, own_uids[doc], (at - starts[doc]).astype(np.int32)))
                count += len(at)
                if count > 200_000:
                    yield flush()
                    held, count = [], 0
        if count:
            yield flush()

    def count(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(parts, ("part",)):
            hashes, uids, at = _unpack(part.column("blob").to_pylist(), "<u8", "<i8", "<i4")
            order = np.argsort(hashes, kind="stable")
            hashes = hashes[order]
            first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            met = np.diff(np.concatenate([first, [len(hashes)]]))
            keep = np.repeat(met > 1, met)
            hot = np.repeat(met > often, met)[keep].astype(np.int32)
            uids, at, hashes = uids[order][keep], at[order][keep], hashes[keep]
            if len(uids):
                yield _lists(RUN, _by(_slots(uids, slots), uids, at, hashes, hot))

    found = rows.select("uid", "text").mapInArrow(find, _LISTS)
    dealt = found.repartition(slots, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(count, _LISTS)


def _joined(part: pa.RecordBatch, most: int = 1 << 17) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Documents in batches of about `most` bytes: ids, all bytes, and where each document ends."""
    own, raw, size = [], [], 0
    for low in range(0, part.num_rows, 64):
        some = part.slice(low, 64)
        for uid, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
            own.append(uid)
            raw.append(text.encode("utf-8", "surrogatepass"))
            size += len(raw[-1])
            if size >= most:
                yield np.array(own), np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])
                own, raw, size = [], [], 0
    if size:
        yield np.array(own), np.frombuffer(b"".join(raw), np.uint8), np.cumsum([len(r) for r in raw])


def front_code(strings: list[bytes]) -> tuple[np.ndarray, bytes]:
    """Of sorted strings of one length: the prefix each shares with the one before, and the rests."""
    flat = np.frombuffer(b"".join(strings), np.uint8).reshape(len(strings), -1)
    length = flat.shape[1]
    differ = flat[1:] != flat[:-1]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), length)
    shared = np.concatenate([[0], shared]).astype("<u2")
    return shared, b"".join([s[k:] for s, k in zip(strings, shared.tolist(), strict=True)])


def decode_run(shared: np.ndarray, rests: bytes, length: int, at: int = 0) -> Iterator[tuple[bytes, int]]:
    """The strings of a run and the prefix each shares with the one before; rests begin at `at`."""
    last = b""
    for k in shared.tolist():
        last = last[:k] + rests[at : at + length - k]
        at += length - k
        yield last, k


def _common(a: bytes, b: bytes, start: int) -> int:
    """The length of the common prefix of two strings of one length, known to be `start` at least."""
    n = len(a)
    while start < n and a[start : start + 16] == b[start : start + 16]:
        start += 16
    if start >= n:
        return n
    while a[start] == b[start]:
        start += 1
    return start


def merge_runs(sources: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[int, bytes, int]]:
    """Merge sorted runs of (string, prefix shared with the one before) with a loser tree.

    Yields (run, string, prefix shared with the output before). Each loser is kept with the
    length of the prefix it shares with the string that beat it. Along a path of the tree these
    lengths are all relative to the last output, so the longer one wins unseen, and only at equal
    lengths are bytes compared, from there on. Equal strings come in the order of their runs.
    """
    size = 1 << max(0, len(sources) - 1).bit_length()
    current: list[bytes | None] = [None] * size
    prefix = [0] * size

    def advance(run: int) -> None:
        got = next(sources[run], None) if run < len(sources) else None
        current[run], prefix[run] = got if got is not None else (None, -1)

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser; the loser's prefix becomes the one it shares with the winner."""
        x, y = current[a], current[b]
        if y is None or x is None:
            return (a, b) if y is None else (b, a)
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        k = _common(x, y, prefix[a])
        if k == len(x):
            winner, loser = (a, b) if a < b else (b, a)
        else:
            winner, loser = (a, b) if x[k] < y[k] else (b, a)
        prefix[loser] = k
        return winner, loser

    for run in range(size):
        advance(run)
        prefix[run] = 0 if current[run] is not None else -1
    losers = [0] * size
    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    best = winners[1] if size > 1 else 0
    while current[best] is not None:
        yield best, current[best], prefix[best]
        advance(best)
        node = (best + size) >> 1
        while node:
            best, losers[node] = play(best, losers[node])
            node >>= 1


class _Shape:
    """A suffix as bytes: hash, bytes from the anchor on, bytes before it reversed, both lengths.

    Its windows have `low` to `high` bytes before the anchor: all of them 0 to width - gram.
    """

    def __init__(self, width: int, gram: int):
        self.right, self.left = width, width - gram
        self.length = 8 + self.right + self.left + 2

    def make(self, head: bytes, text: bytes, at: int, low: int, high: int) -> bytes:
        right, left = text[at : at + self.right - low], text[max(0, at - high) : at][::-1]
        tail = bytes((len(right), len(left)))
        return head + right.ljust(self.right, b"\0") + left.ljust(self.left, b"\0") + tail

    def halves(self, text: bytes, at: int, low: int, high: int) -> Iterator[tuple[bytes, int, int]]:
        """Suffixes for the windows with fewer and with more bytes before the anchor, each with its
        `low` and `high`. The hash is that of the bytes which all windows of the half share."""
        middle = (low + high) // 2
        for low, high in ((low, middle), (middle + 1, high)):
            if max(low, self.right - (len(text) - at)) <= min(high, at):  # else the text has no such window
                shared = b"%d %d " % (low, high) + text[at - low : at + self.right - high]
                yield self.make(hashlib.blake2b(shared, digest_size=8).digest(), text, at, low, high), low, high

    def text(self, key: bytes) -> tuple[bytes, int]:
        """The bytes of a suffix in the order of the text, and the place of the anchor in them."""
        right, left = key[-2], key[-1]
        before = 8 + self.right
        return key[before : before + left][::-1] + key[8 : 8 + right], left


class _Run:
    """Gathers suffixes for sorted runs. Equal ones stay as the earliest; the others are repeats."""

    def __init__(self, width: int, slots: int):
        self.width, self.slots = width, slots
        self.first: dict[bytes, tuple[int, int, int, int]] = {}
        self.spans: list[tuple[int, int, int]] = []

    def add(self, key: bytes, uid: int, at: int, low: int, high: int) -> None:
        own = (uid, at, low, high)
        known = self.first.setdefault(key, own)
        if known is not own:
            late = max(known, own)
            self.first[key] = min(known, own)
            if key[-2] + key[-1] >= self.width:
                self.spans.append((late[0], late[1] - key[-1], late[1] + key[-2]))

    def take(self) -> Iterator[pa.RecordBatch]:
        """A front-coded run for each range, and the spans."""
        if not self.first:
            return
        keys = sorted(self.first)
        own = np.array([self.first[k] for k in keys], np.int64)
        self.first = {}
        leading = np.array([int.from_bytes(k[:4], "big") for k in keys], np.uint64)
        part = (leading * np.uint64(self.slots * RANGES_PER_SLOT) >> np.uint64(32)).astype(np.int64)
        kinds, begin = np.unique(part, return_index=True)
        out = []
        for kind, low, high in zip(kinds.tolist(), begin, [*begin[1:], len(keys)], strict=True):
            shared, rests = front_code(keys[low:high])
            columns = (own[low:high, i].astype(t) for i, t in enumerate(("<i8", "<i4", "u1", "u1")))
            raw = _pack(*columns, shared) + rests
            head = np.array([high - low, len(raw)], "<i8")
            out.append((kind, _pack(head) + pa.compress(raw, codec="zstd", asbytes=True)))
        yield _lists(RUN, out)
        if self.spans:
            yield _lists(SPANS, _span_lists(np.array(self.spans, np.int64), self.slots))
            self.spans = []


def _runs_of_slot(texts: pa.Table, lists: pa.Table, slots: int, width: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Front-coded sorted runs of the slot's suffixes, one per range, and the spans that repeat
    within the slot."""
    shape, run = _Shape(width, gram), _Run(width, slots)
    uids, at, hashes, hot = _unpack(lists.column("blob").to_pylist(), "<i8", "<i4", "<u8", "<i4")
    if not len(uids):
        return
    heads = hashes.astype(">u8").tobytes()
    row_of = {uid: row for row, uid in enumerate(texts.column("uid").to_pylist())}
    column = texts.column("text")
    raw: dict[int, bytes] = {}
    order = np.lexsort((at, uids))
    for i, uid, place, halve in zip(
        order.tolist(), uids[order].tolist(), at[order].tolist(), hot[order].tolist(), strict=True
    ):
        if uid not in raw:
            raw = {uid: column[row_of[uid]].as_buffer().to_pybytes()}
        if halve:
            for key, low, high in shape.halves(raw[uid], place, 0, shape.left):
                run.add(key, uid, place, low, high)
        else:
            run.add(shape.make(heads[8 * i : 8 * i + 8], raw[uid], place, 0, shape.left), uid, place, 0, shape.left)
    yield from run.take()


def _span_lists(spans: np.ndarray, slots: int) -> list[tuple[int, bytes]]:
    uids, low, high = spans.T
    return list(_by(_slots(uids, slots), uids, low.astype("<i4"), high.astype("<i4")))


def _read_run(blob: bytes, length: int) -> tuple[list[np.ndarray], Iterator[tuple[bytes, int]]]:
    n, size = np.frombuffer(blob, "<i8", 2).tolist()
    raw = pa.decompress(blob[16:], size, codec="zstd", asbytes=True)
    uids = np.frombuffer(raw, "<i8", n)
    at = np.frombuffer(raw, "<i4", n, 8 * n)
    low, high = (np.frombuffer(raw, "u1", n, 12 * n + n * i) for i in (0, 1))
    shared = np.frombuffer(raw, "<u2", n, 14 * n)
    return [uids, at, low, high], decode_run(shared, raw, length, 16 * n)


class _Merged:
    """Takes merged suffixes and gathers repeated spans, and suffixes to be compared elsewhere."""

    def __init__(self, width: int, gram: int, slots: int, often: int):
        self.width, self.shape, self.often = width, _Shape(width, gram), often
        self.spans: list[np.ndarray] = []
        self.covered: list[tuple[int, int, int]] = []
        self.group: list[tuple[int, int, int, int, bytes]] = []
        self.large = False
        self.waiting: list[tuple[int, int, int, int, bytes]] = []
        self.halved = _Run(width, slots)

    def add(self, uid: int, at: int, low: int, high: int, key: bytes, shared: int) -> None:
        if self.group and shared == len(key):
            last = self.group[-1]  # the same suffix: the later one repeats
            early, late = ((uid, at), last[:2]) if (uid, at) < last[:2] else (last[:2], (uid, at))
            self.group[-1] = (*early, low, high, key)
            if key[-2] + key[-1] >= self.width:
                self.covered.append((late[0], late[1] - key[-1], late[1] + key[-2]))
            return
        if self.group and shared < 8:
            self.close_group()
        if len(self.group) >= self.often and low < high:
            self.halve()
        self.group.append((uid, at, low, high, key))

    def halve(self) -> None:
        """The group is large: its windows are compared in the ranges of their halves."""
        self.large = True
        for uid, at, low, high, key in self.group:
            text, place = self.shape.text(key)
            for half, *reach in self.shape.halves(text, place, low, high):
                self.halved.add(half, uid, at, *reach)
        self.group = []

    def close_group(self) -> None:
        """Suffixes of one anchor: alone they hold no further repeat."""
        if self.large:
            self.halve()
        elif len(self.group) > 1:
            self.waiting += self.group
            if len(self.waiting) >= 2048:
                self.compare()
        self.group, self.large = [], False

    def compare(self) -> None:
        """Compare all windows of the waiting suffixes; whole groups only."""
        if not self.waiting:
            return
        rows = sorted(self.waiting, key=lambda r: r[:2])
        self.waiting = []
        shape, width = self.shape, self.width
        flat = np.frombuffer(b"".join([r[4] for r in rows]), np.uint8).reshape(len(rows), -1)
        right, left = flat[:, -2].astype(np.int64), flat[:, -1].astype(np.int64)
        body = np.concatenate(
            [flat[:, 8 + shape.right : -2][:, ::-1], flat[:, 8 : 8 + shape.right]], axis=1
        )  # the anchor is at column shape.left
        up, down = _powers(body.shape[1])
        both = []
        for table in (_OF_BYTE, mix(_OF_BYTE)):
            total = np.zeros((len(rows), body.shape[1] + 1), np.uint64)
            np.cumsum(table[body] * up, axis=1, out=total[:, 1:])
            both.append(mix((total[:, width:] - total[:, :-width]) * down[: body.shape[1] - width + 1]))
        column = np.arange(both[0].shape[1])
        inside = (column >= shape.left - left[:, None]) & (column + width <= shape.left + right[:, None])
        row, col = np.nonzero(inside)
        one, two = both[0][row, col], both[1][row, col]
        uid = np.array([r[0] for r in rows], np.int64)[row]
        start = np.array([r[1] for r in rows], np.int64)[row] - shape.left + col
        order = np.lexsort((start, uid, two, one))
        one, two, uid, start = (x[order] for x in (one, two, uid, start))
        new = np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])])
        again = ~new
        # The same place can come twice, through two anchors: it does not repeat itself.
        leader = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
        again &= (uid != uid[leader]) | (start != start[leader])
        self.spans.append(_merge_spans(uid[again], start[again], width))


def _merge_spans(uid: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """Spans covered by windows of `width` bytes: rows of uid, low, high."""
    order = np.lexsort((start, uid))
    uid, start = uid[order], start[order]
    if not len(uid):
        return np.zeros((0, 3), np.int64)
    cut = np.concatenate([[True], (uid[1:] != uid[:-1]) | (start[1:] > start[:-1] + width)])
    low = np.flatnonzero(cut)
    high = np.concatenate([low[1:] - 1, [len(uid) - 1]])
    return np.stack([uid[low], start[low], start[high] + width], axis=1)


def _merge_range(part: pa.Table, slots: int, width: int, gram: int, often: int) -> Iterator[pa.RecordBatch]:
    merged = _Merged(width, gram, slots, often)
    kinds, parts, blobs = (part.column(c).to_pylist() for c in ("kind", "part", "blob"))
    through = [(p, b) for k, p, b in zip(kinds, parts, blobs, strict=True) if k == SPANS]
    if through:
        yield _lists(SPANS, through)
    read = [_read_run(b, merged.shape.length) for k, b in zip(kinds, blobs, strict=True) if k == RUN]
    del blobs
    facts = [columns for columns, _ in read]
    nth = [0] * len(read)
    for run, key, shared in merge_runs([strings for _, strings in read]):
        i = nth[run]
        nth[run] += 1
        uids, at, low, high = facts[run]
        merged.add(int(uids[i]), int(at[i]), int(low[i]), int(high[i]), key, shared)
        if len(merged.halved.first) >= HELD:
            yield from merged.halved.take()
    merged.close_group()
    merged.compare()
    yield from merged.halved.take()
    spans = [*merged.spans, np.array(merged.covered, np.int64).reshape(-1, 3)]
    whole = np.concatenate(spans)
    if len(whole):
        yield _lists(SPANS, _span_lists(whole, slots))


def repeated_spans(
    rows: DataFrame, slots: int, width: int = WIDTH, gram: int = GRAM, often: int = OFTEN
) -> DataFrame:
    """(part, blob) lists of repeated spans for (slot, uid, text) rows with unique, non-NULL uids."""
    spark = rows.sparkSession
    place = shared_path(spark, "anchors")
    with settings(spark, _FEW_ROWS):
        _repeated_anchors(rows, slots, width, gram, often).write.parquet(place)
    lists = spark.read.schema(_LISTS).parquet(place)
    def sort(texts: pa.Table, own: pa.Table) -> pa.Table:
        found = _runs_of_slot(texts, own, slots, width, gram) if texts.num_rows and own.num_rows else ()
        return pa.Table.from_batches(list(found), schema=_EMPTY)

    suffixes = (
        rows.select("slot", "uid", "text")
        .groupBy("slot")
        .cogroup(lists.select(F.col("part").alias("slot"), "blob").groupBy("slot"))
        .applyInArrow(sort, _LISTS)
    )

    def merge(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in runs(parts, ("range",)):
            yield from _merge_range(part, slots, width, gram, often)

    spans = None
    while suffixes is not None:
        # Spans found already only pass through; they go to any task.
        ranged = suffixes.withColumn("range", F.col("part"))
        dealt = ranged.repartition(slots, "range").sortWithinPartitions("range")
        with settings(spark, _FEW_ROWS):
            found = store(dealt.mapInArrow(merge, _LISTS), "repeats")
        own = found.where(F.col("kind") == SPANS).select("part", "blob")
        spans = own if spans is None else spans.union(own)
        # Halves of large groups go on; every round halves their windows, so there are few rounds.
        halves = found.where(F.col("kind") == RUN)
        suffixes = halves if halves.limit(1).count() else None
    remove_path(spark, place)
    return spans


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """The documents with a unique number `__number__` in the order of ids, and the bytes of all texts.

    Unique ids are their own numbers. Otherwise the rows are sorted by id (NULL first) and text
    and numbered in that order, in a stored table.
    """
    facts = docs.groupBy(F.col(id_col).alias("id")).agg(
        F.count("*").alias("n"), F.sum(F.octet_length(F.col(text_col).cast("string"))).alias("bytes")
    )
    row = facts.agg(
        F.max("n").alias("n"), F.sum("bytes").alias("bytes"), F.max(F.col("id").isNull()).alias("gap")
    ).first()
    size = row["bytes"] or 0
    if (row["n"] or 0) > 1 or row["gap"]:
        ordered = docs.orderBy(F.asc_nulls_first(id_col), text_col)
        return store(ordered.withColumn("__number__", F.monotonically_increasing_id()), "numbered"), size
    return docs.withColumn("__number__", F.col(id_col).cast("long")), size


def _apply(
    docs: DataFrame, out: T.StructType, make: Callable[[pa.Table, list[np.ndarray]], list[pa.Array]],
    width: int, gram: int, often: int, slot_bytes: int, id_col: str, text_col: str,
) -> DataFrame:
    """Find repeats, then hand each slot's documents and their merged spans to `make`."""
    numbered, size = _numbered(docs, id_col, text_col)
    slots = max(1, -(-size // slot_bytes))
    placed = numbered.withColumn("__slot__", _slot_of("__number__", slots))
    rows = placed.select(
        F.col("__slot__").alias("slot"), F.col("__number__").alias("uid"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    lists = repeated_spans(rows, slots, width, gram, often)

    def finish(own: pa.Table, spans: pa.Table) -> pa.Table:
        uids, low, high = _unpack(spans.column("blob").to_pylist(), "<i8", "<i4", "<i4")
        order = np.lexsort((low, uids))
        uids, low, high = uids[order], low[order], high[order]
        docs_uid = own.column("__number__").to_numpy()
        begin, end = np.searchsorted(uids, docs_uid), np.searchsorted(uids, docs_uid, side="right")
        merged = [_union(low[b:e], high[b:e]) for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
        return pa.Table.from_arrays(make(own, merged), names=out.names)

    return (
        placed.groupBy("__slot__")
        .cogroup(lists.select(F.col("part").alias("__slot__"), "blob").groupBy("__slot__"))
        .applyInArrow(finish, out)
    )


def _union(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Spans sorted by start, joined where they touch."""
    if not len(low):
        return np.zeros((0, 2), np.int64)
    reach = np.maximum.accumulate(high)
    cut = np.concatenate([[True], low[1:] > reach[:-1]])
    first = np.flatnonzero(cut)
    return np.stack([low[first], reach[np.concatenate([first[1:] - 1, [len(low) - 1]])]], axis=1).astype(np.int64)


def _kept(text: str | None, spans: np.ndarray) -> bytes:
    raw = (text or "").encode("utf-8", "surrogatepass")
    if not len(spans):
        return raw
    edges = [0, *spans.ravel().tolist(), len(raw)]
    return b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)])


def repeat_digests(
    docs: DataFrame,
    width: int = WIDTH,
    gram: int = GRAM,
    often: int = OFTEN,
    slot_bytes: int = SLOT_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, its text in UTF-8.

    NULL and empty texts have nothing to remove. Rows without an id come before all others, rows
    with the same id are ordered by text, and each has its own result. Empty tables give no rows.
    """
    out = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            *[T.StructField(n, T.LongType()) for n in ("n_bytes", "n_removed", "n_spans")],
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def make(own: pa.Table, spans: list[np.ndarray]) -> list[pa.Array]:
        texts = own.column("text").to_pylist()
        kept = [_kept(t, s) for t, s in zip(texts, spans, strict=True)]
        gone = [int((s[:, 1] - s[:, 0]).sum()) for s in spans]
        return [
            own.column("doc_id"),
            pa.array([len(k) + g for k, g in zip(kept, gone, strict=True)], pa.int64()),
            pa.array(gone, pa.int64()),
            pa.array([len(s) for s in spans], pa.int64()),
            pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
        ]

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _apply(own, out, make, width, gram, often, slot_bytes, "doc_id", "text")


def remove_repeats(
    docs: DataFrame,
    width: int = WIDTH,
    gram: int = GRAM,
    often: int = OFTEN,
    slot_bytes: int = SLOT_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The documents with the repeated bytes cut out of their text; all columns are kept.

    A character that is cut in the middle goes as a whole. A NULL text stays NULL.
    """
    columns = docs.columns

    def make(own: pa.Table, spans: list[np.ndarray]) -> list[pa.Array]:
        texts = own.column(text_col).to_pylist()
        kept = [
            _kept(t, s).decode("utf-8", "ignore") if len(s) else t for t, s in zip(texts, spans, strict=True)
        ]
        return [pa.array(kept, pa.string()) if c == text_col else own.column(c) for c in columns]

    return _apply(docs, docs.schema, make, width, gram, often, slot_bytes, id_col, text_col)
