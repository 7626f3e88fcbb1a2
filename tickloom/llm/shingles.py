"""Hashed word shingles of texts, computed for whole batches of texts at once."""

from __future__ import annotations

import numpy as np

from tickloom.llm.common import mix, seeds

_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
# Per byte a random number, capital A-Z as small letters.
_OF_BYTE = seeds(256, 101)
_OF_BYTE[65:91] = _OF_BYTE[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, n - 1).bit_length() if n > 1 << 16 else 1 << 16
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            values = np.full(size, base, np.uint64)
            values[0] = 1
            _POWERS[name] = np.multiply.accumulate(values)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def word_hashes(raw: bytes) -> np.ndarray:
    """A 64-bit hash per word: a run of bytes other than blank and \\x09-\\x0D, A-Z as a-z."""
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    inside = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
    start, end = edges[::2], edges[1::2]
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_OF_BYTE[data] * up, out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str, words: int) -> np.ndarray:
    """The distinct shingles of a text, ascending: of `words` words, or all words if fewer.

    A text without words has none.
    """
    own = word_hashes(text.encode("utf-8", "surrogatepass"))
    if not len(own):
        return own
    n = min(words, len(own))
    count = len(own) - n + 1
    out = np.full(count, n, np.uint64)
    for i in range(n):
        out = mix(out ^ own[i : i + count])
    out.sort()
    return out[np.concatenate([[True], out[1:] != out[:-1]])]
