"""Byte-level BPE by ranks: encoding and decoding of whole texts (operator 3).

A pre-token is merged through a queue of ranks. Each rank has a bucket of positions in a linked
list of parts; a hierarchy of bitmaps marks the ranks whose bucket is not empty, and
find-first-set on each level gives the lowest. Merging changes only the pairs beside it. Their old
entries stay in their buckets and are skipped when they turn up, because the list then holds
another rank for that position. The work is proportional to the parts and merges, so a pre-token
of a hundred thousand letters is no harder than many short ones.

Within a rank the leftmost position comes first, as in the library whose ranks these are.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tickloom.llm.common import keyed_text

_PIECES_KEPT = 1_000_000
_LONGEST_KEPT = 64
_CODECS: dict[tuple[str, str], ByteBpe] = {}


_BITS = 8  # of a rank that one level of the hierarchy tells apart
_LOW = (1 << _BITS) - 1


class ByteBpe:
    """Encoder and decoder for one file of ranks ("base64 rank" lines) and one split pattern."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes_of = {rank: piece for piece, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        # White space that a split at single blanks and line ends could cut apart.
        self.uneven = re.compile(r"\s\s|[^\S \n]|\x00|\A\s|\s\Z")
        # split() knows how this one pattern takes words of letters.
        self.plain = pattern == public_tokenizers.PATTERN
        ranks = self.ranks
        self.first = [[ranks.get(bytes((a, b)), -1) for b in range(256)] for a in range(256)]
        self.digits_of = {rank: b"%d" % rank for rank in ranks.values()}
        self.pieces: dict[str, tuple[int, ...]] = {}
        self.chunks: dict[str, bytes] = {}
        self.trips: dict[str, tuple[int, bytes, bytes]] = {}

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one pre-token.

        The queue is written out here, since calls would cost more than its work: `marks` is its
        upper level, `words` the lower one, `buckets` the positions, the leftmost first.
        """
        ranks, n = self.ranks, len(piece)
        get, first = ranks.get, self.first
        whole = get(piece)
        if whole is not None:
            return (whole,)
        following = list(range(1, n + 1))
        before = list(range(-1, n))
        # The rank of the part at a position joined with the next part; an entry of the queue
        # counts only while it agrees with this.
        joined = [first[a][b] for a, b in zip(piece, piece[1:], strict=False)]
        joined.append(-1)
        buckets: dict[int, list[int]] = {}
        words: dict[int, int] = {}
        marks = 0
        fresh = [(rank, i) for i, rank in enumerate(joined) if rank >= 0]
        while True:
            for rank, i in fresh:
                if rank in buckets:
                    heapq.heappush(buckets[rank], i)
                else:
                    buckets[rank] = [i]
                    high = rank >> _BITS
                    words[high] = words.get(high, 0) | 1 << (rank & _LOW)
                    marks |= 1 << high
            if not marks:
                break
            high = (marks & -marks).bit_length() - 1
            word = words[high]
            rank = high << _BITS | (word & -word).bit_length() - 1
            bucket = buckets[rank]
            i = heapq.heappop(bucket)
            if not bucket:
                del buckets[rank]
                word &= word - 1
                words[high] = word
                if not word:
                    marks &= marks - 1
            fresh = []
            if joined[i] != rank:
                continue  # stale
            gone = following[i]
            after = following[gone]
            following[i] = after
            before[after] = i
            joined[gone] = joined[i] = -1
            if after < n:
                rank = get(piece[i : following[after]], -1)
                if rank >= 0:
                    joined[i] = rank
                    fresh.append((rank, i))
            left = before[i]
            if left >= 0:
                rank = get(piece[left:after], -1)
                if rank != joined[left]:
                    joined[left] = rank
                    if rank >= 0:
                        fresh.append((rank, left))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : following[i]]])
            i = following[i]
        return tuple(out)

    def split(self, part: str) -> list[str]:
        """The matches of the pattern. A word of letters, with a blank or line end before it or a
        mark behind it, is by far the most frequent part and needs no search."""
        if not self.plain:
            return self.pattern.findall(part)
        head, body = (part[:1], part[1:]) if part[:1] in (" ", "\n") else ("", part)
        if head == "\n":
            rest = self.split(body) if body[:1] not in (" ", "\n") else None
            return [head, *rest] if body and rest is not None else self.pattern.findall(part)
        if body.isalpha():
            return [part]
        if body[-1:] in (".", ",", "!") and body[:-1].isalpha():
            return [part[:-1], body[-1]]
        return self.pattern.findall(part)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, each match of the pattern merged on its own."""
        out: list[int] = []
        for piece in self.split(text):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = self.merge(piece.encode("utf-8"))
                if len(piece) <= _LONGEST_KEPT:
                    if len(self.pieces) >= _PIECES_KEPT:
                        self.pieces.clear()
                    self.pieces[piece] = ids
            out += ids
        return out

    def encode_raw(self, text: str) -> bytes:
        """The ids as 32-bit integers.

        Where white space comes as single blanks and line ends inside the text, no match of the
        pattern reaches across the place before one, and the parts between are kept.
        """
        if self.uneven.search(text):
            return _raw(self.encode(text))
        parts = text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")
        chunks = self.chunks
        found = list(map(chunks.get, parts))
        if None in found:
            if len(chunks) > _PIECES_KEPT:
                chunks.clear()
            for i, known in enumerate(found):
                if known is None:
                    part = parts[i]
                    found[i] = known = chunks.get(part) or _raw(self.encode(part))
                    if len(part) <= _LONGEST_KEPT:
                        chunks[part] = known
        return b"".join(found)

    def trip(self, part: str) -> tuple[int, bytes, bytes]:
        """How many ids a text has, the ids in decimal, and the bytes that they decode to."""
        ids = self.encode(part)
        return len(ids), self.decimal(ids), self.decode(ids)

    def round_trip(self, text: str) -> tuple[int, bytes, bytes]:
        """trip() of a whole text, from its parts where they are kept; see encode_raw()."""
        if not text or self.uneven.search(text):
            return self.trip(text)
        parts = text.replace(" ", "\x00 ").replace("\n", "\x00\n").split("\x00")
        trips = self.trips
        found = list(map(trips.get, parts))
        if None in found:
            if len(trips) > _PIECES_KEPT:
                trips.clear()
            for i, known in enumerate(found):
                if known is None:
                    part = parts[i]
                    found[i] = known = trips.get(part) or self.trip(part)
                    if len(part) <= _LONGEST_KEPT:
                        trips[part] = known
        counts, decimals, decoded = zip(*found, strict=True)
        return sum(counts), b",".join(decimals), b"".join(decoded)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))

    def decimal(self, ids: Iterable[int]) -> bytes:
        """The ids in decimal, joined by commas."""
        return b",".join(map(self.digits_of.__getitem__, ids))


def _raw(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_bpe(path: str, pattern: str) -> ByteBpe:
    """The worker's codec for a vocabulary; it lives as long as the worker."""
    if (path, pattern) not in _CODECS:
        _CODECS[path, pattern] = ByteBpe(path, pattern)
    return _CODECS[path, pattern]


def encode_documents(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and the ids of each whole text, as an array; NULL and empty texts have none.

    One pass over the input, without a shuffle. Repeated rows are encoded each.
    """

    def encode(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(vocabulary, pattern)
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                ids = [np.frombuffer(codec.encode_raw(t), "<i4") for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"]
                )

    return keyed_text(docs, id_col, text_col).mapInArrow(encode, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id and the text's bytes from rows of encode_documents; NULL ids give NULL."""

    def decode(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(vocabulary, pattern)
        for part in parts:
            texts = [None if ids is None else codec.decode(ids) for ids in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"]
            )

    return encoded.select("doc_id", "ids").mapInArrow(decode, "doc_id long, text binary")


def round_trip_digests(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode and decode each text and give digests of both, without moving ids between tasks:
    doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas), decoded_sha256."""

    def digest(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(vocabulary, pattern)
        for part in parts:
            for at in range(0, part.num_rows, 256):
                some = part.slice(at, 256)
                counts, ids_sha, text_sha = [], [], []
                for text in some.column(1).to_pylist():
                    n, decimal, decoded = codec.round_trip(text)
                    counts.append(n)
                    ids_sha.append(hashlib.sha256(decimal).hexdigest())
                    text_sha.append(hashlib.sha256(decoded).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha), pa.array(text_sha)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return keyed_text(docs, id_col, text_col).mapInArrow(digest, schema)
