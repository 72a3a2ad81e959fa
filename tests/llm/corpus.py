"""Small frames for the corpus operators: NULLs, empty and long texts, ties, copies, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, bits long, digest string, score double"


def words(rng: random.Random, n: int, alphabet: str = "abcdefgh") -> list[str]:
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n)]


def frame(spark, texts: list[tuple[int | None, str | None]], langs=None, sources=None):
    rows = [
        (i, t, langs[k] if langs else "en", sources[k] if sources else f"s{k % 3}", None if t is None else len(t), 7, "x", 0.5)
        for k, (i, t) in enumerate(texts)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts(rng: random.Random) -> list[tuple[int | None, str | None]]:
    """Texts every operator has to cope with; ids 1 to 12 and NULL."""
    long = " ".join(words(rng, 3000))
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "É́tude 日本語 \U0001f600 – ok"),
        (6, long),
        (7, long),
        (8, long + " tail"),
        (9, "a b c d e f"),
        (9, "a b c d e f"),
        (None, "a b c d e f"),
        (None, None),
        (10, "x" * 5000),
        (11, "!!! ??? ..."),
        (12, "<|endoftext|> and <|startoftext|> <|ENDOFTEXT|>"),
    ]
