"""Packing of tokenised documents into sequences by vector best fit (operator 10).

Each sequence has three capacities: tokens, documents, and attention cost (the sum of squared
lengths of its pieces). Pieces are taken in descending order of length, and each goes to the
open sequence that fits under every capacity and scores best: either the smallest weighted norm
of what would be left, or the largest weighted dot product of demand and residual. Without a
fit, a sequence is opened.

Pieces are dealt into groups of bounded size by a hash, whatever their document or source, and
each group is packed by one task. So a group costs a fraction of one sequence at most, the work
grows in proportion to the data, and no key gathers rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import keyed_text
from tickloom.llm.word_tokens import word_encoder
from tickloom.session import store

SEQUENCE_TOKENS = 4096
PIECES_PER_GROUP = 12_000
# Of tokens, documents and attention cost. Tokens decide; the others break ties.
WEIGHTS = (1.0, 1e-4, 1e-4)


def cut_pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    tokens: int = SEQUENCE_TOKENS,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of at most `tokens` ids: doc_id, piece, start, length, ids_crc32 (and ids).

    A document is its text's ids and end_id; a longer one is cut into full pieces and a rest.
    NULL and empty texts are one piece with the end id. Repeated rows each have their pieces.
    """
    kinds = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}
    if with_ids:
        kinds["ids"] = "array<int>"

    def cut(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        for part in parts:
            for at in range(0, part.num_rows, 512):
                some = part.slice(at, 512)
                keys, texts = some.column(0).to_pylist(), some.column(1).to_pylist()
                rows: list[tuple] = []
                for key, raw in zip(keys, encoder.encode(texts), strict=True):
                    raw += end
                    for number, low in enumerate(range(0, len(raw), 4 * tokens)):
                        own = raw[low : low + 4 * tokens]
                        row = (key, number, low // 4, len(own) // 4, zlib.crc32(own))
                        rows.append((*row, np.frombuffer(own, "<u4").astype("i4")) if with_ids else row)
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                columns = [
                    pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), types, strict=False)
                ]
                yield pa.RecordBatch.from_arrays(columns, names=list(kinds))

    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    return keyed_text(docs, id_col, text_col).mapInArrow(cut, schema)


def best_fit(
    lengths: np.ndarray,
    capacity: tuple[float, float, float],
    weights: tuple[float, float, float] = WEIGHTS,
    score: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """The sequence of each piece and its offset there. `lengths` are positive."""
    if score not in ("norm", "dot"):
        raise ValueError(f"score must be 'norm' or 'dot', not {score!r}")
    cap, weight = np.array(capacity, float), np.array(weights, float)
    order = np.argsort(-lengths, kind="stable")
    place, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    left = np.zeros((3, 1024))  # residual capacities of the open sequences
    name = np.zeros(1024, np.int64)
    n = made = 0
    least = int(lengths.min()) if len(lengths) else 0
    for i in order.tolist():
        size = float(lengths[i])
        need = np.array([size, 1.0, size * size])
        if (need > cap).any():
            raise ValueError(f"a piece of {int(size)} tokens exceeds the capacity of a sequence")
        best = -1
        if n:
            after = left[:, :n] - need[:, None]
            fits = (after >= 0).all(axis=0)
            if fits.any():
                if score == "norm":
                    value = (weight[:, None] * (after / cap[:, None]) ** 2).sum(axis=0)
                else:
                    value = -(weight * need / cap**2) @ left[:, :n]
                best = int(np.argmin(np.where(fits, value, np.inf)))
        if best < 0:
            if n == left.shape[1]:
                left = np.concatenate([left, np.zeros_like(left)], axis=1)
                name = np.concatenate([name, np.zeros_like(name)])
            best, n = n, n + 1
            left[:, best], name[best] = cap, made
            made += 1
        place[i], offset[i] = name[best], int(cap[0] - left[0, best])
        left[:, best] -= need
        if left[0, best] < least or left[1, best] < 1 or left[2, best] < least * least:
            n -= 1  # full: the last open sequence takes its place
            left[:, best], name[best] = left[:, n], name[n]
    return place, offset


def pack_pieces(
    pieces: DataFrame,
    tokens: int = SEQUENCE_TOKENS,
    documents: int | None = None,
    cost: int | None = None,
    weights: tuple[float, float, float] = WEIGHTS,
    score: str = "norm",
    per_group: int = PIECES_PER_GROUP,
    length_col: str = "length",
) -> DataFrame:
    """Add sequence_id and offset to pieces, in place of columns so called; all others are kept.

    Without limits of their own, documents and cost get those that the tokens imply. Lengths of
    NULL or below 1 take no room: they get NULL for both columns. Pieces are counted first, so
    they should be cheap to read twice (stored). Ties are broken by row order within a group.
    `per_group` bounds a task's rows and the open sequences it compares a piece with.
    """
    pieces = pieces.drop("sequence_id", "offset", "_group")
    capacity = (float(tokens), float(documents or tokens), float(cost or tokens * tokens))
    groups = max(1, -(-pieces.count() // per_group))
    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["_group"].iloc[0])
        rows = group.drop(columns="_group")
        lengths = rows[length_col].fillna(0).to_numpy(np.int64)
        real = lengths > 0
        place, offset = best_fit(lengths[real], capacity, weights, score)
        for column, values in (("sequence_id", (number << 32) + place), ("offset", offset)):
            full = np.full(len(rows), None, dtype=object)
            full[real] = values
            rows[column] = pd.array(full, dtype="Int64")
        return rows

    dealt = pieces.withColumn(
        "_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups))
    )
    return dealt.groupBy("_group").applyInPandas(pack, schema)


def pack_documents(
    docs: DataFrame, vocabulary: str, end_id: int, tokens: int = SEQUENCE_TOKENS, **limits
) -> DataFrame:
    """Tokenise, cut and pack: a row per piece with its sequence and the offset in it.

    The pieces, a few numbers each, are stored once, so the texts are tokenised once.
    """
    return pack_pieces(store(cut_pieces(docs, vocabulary, end_id, tokens), "pieces"), tokens, **limits)
