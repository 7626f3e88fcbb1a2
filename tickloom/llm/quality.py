"""Naive Bayes support vectors for document quality (operator 6).

A word becomes its shape (runs of capitals, small letters, digits, and the other characters as
they stand; a mark if it repeats the word before), and the features are the indicators of 1- to 3-grams of
shapes, hashed to 2**bits places. A word with a long shape (text without white space, addresses, glued
junk) also has the 1- to 3-grams of the pieces of its shape, so its inside counts as well.
Each indicator is scaled by its class log-count ratio; a linear model with hinge loss is fitted to
the scaled, length-normalised vectors by dual coordinate descent, and a logistic curve turns its
margin into a score from 0 to 1.

The model is fitted on at most `sample` labelled rows, drawn by a hash of the id, half of each
class where there are enough. The logistic curve weighs them so that the classes count as they do
among all labels: a score means the same at every size. Scoring is one pass over all documents
without a shuffle; every text is read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import collect_features, labelled_sample, mix, with_text

BITS = 18
SAMPLE = 8000
THRESHOLD = 0.3
_WORDS_KEPT = 150_000
_LONG_SHAPE = 12
_LONGEST_KEPT = 100
_PIECE = re.compile(r"[^\W\d_]+|\d+|.", re.DOTALL)
_REPEATED = np.uint64(0x9E3779B97F4A7C15)
_RUNS = ((re.compile(r"[^\W\d_]+"), lambda m: _case(m[0])), (re.compile(r"\d+"), lambda m: "0"))
_SHAPES: dict[str, int] = {}


def _case(run: str) -> str:
    if run.islower():
        return "a"
    if run.isupper():
        return "A" if len(run) > 1 else "I"
    return "Aa" if run[0].isupper() and run[1:].islower() else "aA"


def shape(word: str) -> str:
    for pattern, made in _RUNS:
        word = pattern.sub(made, word)
    return word


def _shape_hash(word: str, inner: list[np.ndarray]) -> int:
    """The hash of a word's shape; the hashes of a long shape's pieces are added to `inner`."""
    known = _SHAPES.get(word)
    if known is None:
        made = shape(word)
        known = xxhash.xxh3_64_intdigest(made)
        if len(made) > _LONG_SHAPE:
            inner.append(_piece_hashes(word))
        elif len(word) <= _LONGEST_KEPT:
            if len(_SHAPES) > _WORDS_KEPT:
                _SHAPES.clear()
            _SHAPES[word] = known
    return known


def _piece_hashes(word: str) -> np.ndarray:
    """Of each run or other character of a word, the hash of its shape, marked if it repeats the one before."""
    pieces = _PIECE.findall(word)
    own = np.array([xxhash.xxh3_64_intdigest(shape(p)) for p in pieces], np.uint64)
    own[[False, *(a == b for a, b in zip(pieces, pieces[1:], strict=False))]] ^= _REPEATED
    return own


def _grams(own: np.ndarray, kind: int) -> Iterator[np.ndarray]:
    """The 1- to 3-grams of hashes; those of different kinds differ."""
    for n in (1, 2, 3):
        count = len(own) - n + 1
        if count > 0:
            gram = np.full(count, kind + n, np.uint64)
            for i in range(n):
                gram = mix(gram ^ own[i : i + count])
            yield gram


def features(text: str, bits: int = BITS) -> np.ndarray:
    """The distinct hashed features of a text, ascending. Never empty: every text has a marker."""
    words, inner = text.split(), []
    own = np.array([_shape_hash(w, inner) for w in words], np.uint64)
    if len(words) > 1:
        same = [False, *(a == b for a, b in zip(words, words[1:], strict=False))]
        own[np.array(same)] ^= _REPEATED
    grams = [np.array([len(words) == 0], np.uint64), *_grams(own, 0)]
    for pieces in inner:
        grams.extend(_grams(pieces, 3))
    return np.unique(mix(np.concatenate(grams)) >> np.uint64(64 - bits)).astype(np.int32)


@dataclass
class Model:
    """Weights per feature (ratio times coefficient) and the logistic curve of the margin."""

    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, found: np.ndarray) -> float:
        scale = self.scale[found]
        norm = float(np.sqrt((scale * scale).sum()))
        return self.bias + float((self.weights[found] * scale).sum()) / norm if norm else self.bias

    def score(self, found: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(found) + self.shift, -30, 30))))


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, size: int, cost: float, epochs: int
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the squared norm plus `cost` times the hinge losses.

    The bias is the weight of a constant feature. Each step solves one dual variable exactly,
    in a new random order per epoch, and stops when an epoch moves none by much.
    """
    weights, bias = np.zeros(size), 0.0
    alpha = np.zeros(len(rows))
    square = np.array([float((v * v).sum()) + 1.0 for _, v in rows])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)).tolist():
            at, values = rows[i]
            gradient = signs[i] * (float(weights[at] @ values) + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), cost)
            step = (new - alpha[i]) * signs[i]
            if step:
                weights[at] += step * values
                bias += step
                moved = max(moved, abs(step))
                alpha[i] = new
        if moved < 1e-3 * cost:
            break
    return weights, bias


def logistic(margins: np.ndarray, good: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve through weighted margins, with smoothed targets."""
    n1, n0 = float(weight[good].sum()), float(weight[~good].sum())
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (target - p)) - 1e-3 * beta)
        beta += step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def fit(
    found: list[np.ndarray],
    good: np.ndarray,
    bits: int,
    cost: float = 1.0,
    epochs: int = 40,
    weight: np.ndarray | None = None,
) -> Model:
    """A model from feature lists, labels and what each row counts for in the curve; without both
    classes it gives the one there is (0.5 without any)."""
    size = 1 << bits
    if not good.any() or good.all():
        share = float(good.mean()) if len(good) else 0.5
        shift = 5.0 * (2 * share - 1)
        return Model(np.zeros(size), np.zeros(size), 0.0, 0.0, shift)
    counts = [np.full(size, 1.0), np.full(size, 1.0)]
    for at, label in zip(found, good, strict=True):
        counts[int(label)][at] += 1
    n = [float((~good).sum()) + 2, float(good.sum()) + 2]
    scale = np.log((counts[1] / n[1]) / (counts[0] / n[0]))
    # Places that neither class has keep a ratio of 0.
    scale[(counts[0] == 1) & (counts[1] == 1)] = 0.0
    rows = []
    for at in found:
        values = scale[at]
        rows.append((at, values / max(float(np.sqrt((values * values).sum())), 1e-12)))
    signs = np.where(good, 1.0, -1.0)
    # The curve is fitted to margins of rows that the model of the other half did not see.
    half = np.arange(len(rows)) % 2 == 0
    margins = np.zeros(len(rows))
    for seen in (half, ~half):
        w, b = dual_coordinate_descent(
            [r for r, s in zip(rows, seen, strict=True) if s], signs[seen], size, cost, epochs
        )
        for i in np.flatnonzero(~seen):
            margins[i] = float(w[rows[i][0]] @ rows[i][1]) + b
    slope, shift = logistic(margins, good, np.ones(len(rows)) if weight is None else weight)
    weights, bias = dual_coordinate_descent(rows, signs, size, cost, epochs)
    return Model(scale, weights, bias, slope, shift)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document belongs to the fifth that no label is learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    sample: int = SAMPLE,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Model:
    """Fit on a bounded sample of labelled documents outside the held-out fifth."""
    rows = labelled_sample(docs, labels.where(~held_out(id_col)), label_col, sample, id_col, text_col)
    found, label, weight = collect_features(rows, lambda text: features(text, bits))
    return fit(found, label == 1, bits, weight=weight)


def score_documents(
    docs: DataFrame,
    model: Model,
    bits: int = BITS,
    text_col: str = "text",
    score_col: str = "quality_score",
) -> DataFrame:
    """The documents with a score column. NULL texts score as empty ones; repeated rows score alike.

    The model that goes to the tasks has 2 * 2**bits numbers, whatever the corpus.
    """
    return with_text(
        docs,
        text_col,
        score_col,
        T.DoubleType(),
        lambda texts: [model.score(features(text, bits)) for text in texts],
    )


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least `threshold`."""
    scored = score_documents(docs, model, score_col="_quality_score")
    return scored.where(F.col("_quality_score") >= threshold).drop("_quality_score")
