"""Small tables with everything that can be odd about a row."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, n int, contamination string"


def odd_rows(texts: list[str] | None = None) -> list[tuple]:
    """Rows with NULLs in any column, empty, blank, long and repeated texts, and columns with clashing names."""
    texts = texts or ["Of words a few, and of 12 numbers.", "été à la plage", "", " \n\t", None, "x" * 5_000, "a b " * 20_000]
    rows = [(i, t, "en", "s", 1, True, 2, "c") for i, t in enumerate(texts)]
    rows += [(None, texts[0], None, None, None, None, None, None), (len(texts), texts[0], None, "s", 0, False, 1, "c"), rows[0]]
    return rows


def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def prose(rng: random.Random, words: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(words)]
