"""Token ids of whole texts from a tokenizer that never joins text across white space.

The library spends most of its time on words it has met before. A vocabulary whose
pre-tokenizer drops white space gives a text the ids of its words, one after the other, so
each worker keeps the ids of the words it has seen and hands the library the new ones only.
A text with the string of a special token goes to the library as a whole.
"""

from __future__ import annotations

import os
import re

import numpy as np

# A word and the punctuation behind it are separate pre-tokens; the apostrophe is left out
# because it opens contractions.
_TAIL = ".,;:!?*&$%#|"
_WORDS_KEPT = 600_000
_ENCODERS: dict[str, WordEncoder] = {}


class WordEncoder:
    """encode(texts) gives each text's ids as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join(map(re.escape, added))) if added else None
        suffix = getattr(self.library.model, "end_of_word_suffix", None) or ""
        self.ends = np.zeros(self.size, dtype=bool)
        for token, number in self.library.get_vocab(with_added_tokens=True).items():
            self.ends[number] = bool(suffix) and token.endswith(suffix)
        self.known: dict[str, bytes] = {"": b""}
        self.cores: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [text.replace("\n", " ").split(" ") for text in texts]
        known, out = self.known, []
        if len(known) > _WORDS_KEPT:
            known.clear()
            known[""] = b""
        missing: set[str] = set()
        for words in split:
            missing.update(words)
        missing.difference_update(known)
        if missing:
            self._learn(missing)
        for text, words in zip(texts, split, strict=True):
            if self.whole is not None and self.whole.search(text):
                out.append(self._library([text])[0])
            else:
                out.append(b"".join([known[word] for word in words]))
        return out

    def _learn(self, words: set[str]) -> None:
        """Look new words up by their lower-case core, and give the library the new cores."""
        if len(self.cores) > _WORDS_KEPT:
            self.cores.clear()
            self.cores[""] = b""
        parts = {word: _core(word) for word in words}
        pieces = {piece for pair in parts.values() for piece in pair}
        new = [piece for piece in pieces if piece not in self.cores]
        self.cores.update(zip(new, self._many(new), strict=True))
        for word, (core, tail) in parts.items():
            self.known[word] = self.cores[core] + self.cores[tail] if tail else self.cores[core]

    def _many(self, words: list[str], at_once: int = 1024) -> list[bytes]:
        """Ids of words. Words of letters only are joined for the library: each is one
        pre-token, whose last id, and no other, ends a word."""
        found: dict[str, bytes] = {}
        plain = [word for word in words if word.isalpha()]
        for at in range(0, len(plain), at_once):
            chunk = plain[at : at + at_once]
            ids = np.frombuffer(self._library([" ".join(chunk)])[0], "<u4")
            ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(ends) == len(chunk):
                raw, start = ids.tobytes(), 0
                for word, end in zip(chunk, ends, strict=True):
                    found[word] = raw[4 * start : 4 * end]
                    start = end
        rest = [word for word in words if word not in found]
        found.update(zip(rest, self._library(rest), strict=True))
        return [found[word] for word in words]

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]


def _core(word: str) -> tuple[str, str]:
    """A word's lower-case core and its tail of punctuation.

    Only for Latin-1 words: there lower case and Unicode normal form are plain.
    """
    try:
        word.encode("latin-1")
    except UnicodeEncodeError:
        return word, ""
    core = word.rstrip(_TAIL)
    if core and not core[-1].isalnum():
        return word, ""
    return core.lower(), word[len(core) :]


def word_encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; it lives as long as the worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]
