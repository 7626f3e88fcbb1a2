"""Small corpora with awkward rows."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, label int, key string, _stored string"
SF_DIR = "/root/testdata/sf0.001"


def documents(spark, rows):
    """Rows of (doc_id, text), with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "k", "s") for i, t in rows], DOCS)


def words(draw: random.Random, count: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{draw.randrange(vocabulary)}{draw.choice(['', '', ',', '.'])}" for _ in range(count))


def awkward() -> list[tuple[int | None, str | None]]:
    """NULL ids and texts, empty and blank texts, repeated rows and ids, odd characters, long texts."""
    draw = random.Random(5)
    long = words(draw, 6000)
    return [
        (4, "One two three four five six seven"),
        (None, "no id"),
        (None, None),
        (2, None),
        (1, ""),
        (3, " \t\n "),
        (9, long),
        (8, long),
        (8, "the same id, another text 😀 é́ 漢字"),
        (7, "exactly twice"),
        (7, "exactly twice"),
        (6, "x" * 5000),
        (5, "tab\there\x1cthere  'S it's ¶ <|endoftext|> don't"),
    ]
