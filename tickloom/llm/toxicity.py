"""Classifier chains for toxicity categories (operator 9).

The categories have an order. Each has a linear (logistic) model over indicators of words and of
word beginnings, and the models of later categories also see the probabilities that earlier ones
give. For training, those probabilities are out of fold: each comes from a model that did not see
the document, so a later model learns how far an earlier one can be trusted on new text. For
prediction, models fitted to all training rows are used.

Word beginnings find inflected forms that the training rows do not hold. Of all hashed indicators,
the model keeps those whose share among the positive rows differs most from that among the
negative ones, by their chi-squared statistic, so a long clean text is not condemned by the sum
of many chance features.

The training sample is drawn by class; rows weigh as much as makes the classes count as they do
among all labels, so a probability means the same at every size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import collect_features, labelled_sample, with_text

BITS = 20
SAMPLE = 8000
FEATURES = 400
FOLDS = 5
THRESHOLD = 0.3
_BEGINNINGS = (4, 5, 6)
_WORDS_KEPT = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def word_features(word: str, bits: int = BITS) -> Iterator[int]:
    yield xxhash.xxh3_64_intdigest(word) >> (64 - bits)
    for n in _BEGINNINGS:
        if len(word) > n:
            yield xxhash.xxh3_64_intdigest(f"{word[:n]}~") >> (64 - bits)


def features(text: str, bits: int = BITS) -> np.ndarray:
    """The distinct hashed indicators of a text."""
    found = {f for word in set(_WORD.findall(text.lower())) for f in word_features(word, bits)}
    return np.sort(np.fromiter(found, np.int32, len(found)))


def logistic_fit(
    x: np.ndarray, y: np.ndarray, ridge: float = 0.1, steps: int = 30, weight: np.ndarray | None = None
) -> np.ndarray:
    """Coefficients, the constant last, by Newton steps with a ridge penalty; rows may have weights."""
    weight = np.ones(len(x)) if weight is None else weight
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _curve(x @ beta)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, x.T @ (weight * (y - p)) - penalty * beta)
        size = np.abs(step).max()
        beta += step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-5:
            break
    return beta


def _curve(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Chain:
    """places: the kept indicators; models: per category, coefficients of the indicators, of the
    earlier categories' probabilities, and the constant."""

    categories: tuple[str, ...]
    places: np.ndarray
    models: list[np.ndarray]
    bits: int = BITS
    known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def indicators(self, text: str) -> np.ndarray:
        """Columns of the kept indicators in a text; a word is looked up once per worker."""
        out: set[int] = set()
        for word in set(_WORD.findall(text.lower())):
            own = self.known.get(word)
            if own is None:
                if len(self.known) > _WORDS_KEPT:
                    self.known.clear()
                own = []
                for f in word_features(word, self.bits):
                    at = int(np.searchsorted(self.places, f))
                    if at < len(self.places) and self.places[at] == f:
                        own.append(at)
                self.known[word] = own = tuple(own)
            out.update(own)
        return np.fromiter(out, np.int64, len(out))

    def probabilities(self, text: str) -> list[float]:
        at, n, out = self.indicators(text), len(self.places), []
        for beta in self.models:
            z = beta[at].sum() + beta[-1] + sum(b * p for b, p in zip(beta[n:-1], out, strict=True))
            out.append(float(_curve(np.array(z))))
        return out


def fit_chain(
    found: list[np.ndarray],
    labels: dict[str, np.ndarray],
    keep: int = FEATURES,
    folds: int = FOLDS,
    bits: int = BITS,
    weight: np.ndarray | None = None,
) -> Chain:
    """A chain from feature lists, a 0/1 array per category, in chain order, and weights of the rows.

    A category without both classes gets the constant that its rows have.
    """
    n, size = len(found), 1 << bits
    weight = np.ones(n) if weight is None else weight
    best = np.zeros(size)
    everywhere = np.zeros(size)
    for at in found:
        everywhere[at] += 1
    for y in labels.values():
        inside, pos = np.zeros(size), float(y.sum())
        for at, label in zip(found, y, strict=True):
            if label:
                inside[at] += 1
        if 0 < pos < n:
            expected = everywhere * pos / n
            spread = expected * (1 - pos / n) * (1 - everywhere / n) + 1e-9
            best = np.maximum(best, np.where(everywhere >= 3, (inside - expected) ** 2 / spread, 0.0))
    order = np.argsort(-best, kind="stable")[:keep]
    places = np.sort(order[best[order] > 10.8])  # chi-squared of one degree at 0.1 %
    x = np.zeros((n, len(places)))
    for i, at in enumerate(found):
        x[i, np.flatnonzero(np.isin(places, at, assume_unique=True))] = 1.0
    fold = np.arange(n) % folds
    models, earlier = [], np.zeros((n, 0))
    for y in labels.values():
        own = np.concatenate([x, earlier], axis=1)
        y = y.astype(float)
        if n == 0 or y.min() == y.max():
            constant = np.zeros(own.shape[1] + 1)
            constant[-1] = 0.0 if n == 0 else 8.0 * (2 * y[0] - 1)
            models.append(constant)
            out_of_fold = np.full(n, _curve(constant[-1:])[0] if n else 0.5)
        else:
            models.append(logistic_fit(own, y, weight=weight))
            out_of_fold = np.zeros(n)
            for k in range(folds):
                beta = logistic_fit(own[fold != k], y[fold != k], weight=weight[fold != k])
                out_of_fold[fold == k] = _curve(own[fold == k] @ beta[:-1] + beta[-1])
        earlier = np.concatenate([earlier, out_of_fold[:, None]], axis=1)
    return Chain(tuple(labels), places, models, bits)


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    sample: int = SAMPLE,
    strong: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> Chain:
    """A chain of two categories, `label_col` and "severe_" + label_col, from a bounded sample.

    Where only one category is labelled, the second is derived: a labelled text with at least
    `strong` distinct indicators that positive rows have twenty times as often as negative ones.
    """
    rows = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    found, label, weight = collect_features(rows, features)
    counts = [np.full(1 << BITS, 0.5), np.full(1 << BITS, 0.5)]
    for at, y in zip(found, label, strict=True):
        counts[y][at] += 1
    n = [max(1, int((label == k).sum())) for k in (0, 1)]
    telling = (counts[1] / n[1] > 20 * counts[0] / n[0]) & (counts[1] > 5)
    severe = np.array([int(y and telling[at].sum() >= strong) for at, y in zip(found, label, strict=True)], np.int64)
    return fit_chain(found, {label_col: label, f"severe_{label_col}": severe}, weight=weight)


def score_documents(
    docs: DataFrame, chain: Chain, text_col: str = "text", score_col: str = "toxicity"
) -> DataFrame:
    """The documents with a struct column that has a probability per category.

    NULL and empty texts are scored by the constants. Repeated rows score alike.
    """
    kind = T.StructType([T.StructField(c, T.DoubleType()) for c in chain.categories])
    return with_text(
        docs,
        text_col,
        score_col,
        kind,
        lambda texts: [dict(zip(chain.categories, chain.probabilities(t), strict=True)) for t in texts],
    )


def flag_toxic(scored: DataFrame, category: str, threshold: float = THRESHOLD, score_col: str = "toxicity") -> DataFrame:
    return scored.withColumn("toxic", (F.col(score_col)[category] >= threshold).cast("int"))
