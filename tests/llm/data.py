"""Small corpora for the tests, made from fixed seeds."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size string, key int, score string, text_sha256 string"
"""The columns of documents, and some whose names the operators use for themselves."""


def frame(spark, rows):
    """Rows (doc_id, text) or (doc_id, text, source) with extra columns of clashing names."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or ""), "x", 1, "y", "z") for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def sentence(rng: random.Random, words: int) -> list[str]:
    return ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(words)]


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice("abcdefghij") * 3
    return words


def odd_rows() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, a repeated id, short and very long texts, other scripts."""
    long = " ".join(sentence(random.Random(9), 40_000))
    return [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two three four"), (6, "One two three FOUR"),
        (7, long), (8, long), (8, long), (9, long + " end"), (None, "no id at all, but a text of some words"),
        (None, "no id at all, but a text of some words"), (10, "日本語 の テキスト です 。 はい"), (11, "é è ç à x"),
        (12, "same id"), (12, "other text of the same id here"), (13, "\x00 odd \x1c bytes \x7f"), (14, "tie one two three four five"),
        (15, "tie one two three four five"),
    ]
