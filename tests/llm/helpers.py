"""Small tables with nulls, empty and long texts, ties, repeats and clashing columns."""

from __future__ import annotations

import random

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and to thing reand onth ingth weren ouht éàn ñoß zwischen 12 a-b x".split()


def documents(spark, texts, first: int = 0):
    """Documents with ids from ``first`` on; a text may be a whole row instead."""
    rows = [t if isinstance(t, tuple) else (first + i, t, "en", f"s{i % 3}", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", ".", ",", "\n"]) for _ in range(n))


def odd_texts() -> list:
    return [None, "", " \n\t ", "a", "a", "a  ", "é ü", "\U0001f600 \U00010400x", prose(1, 50), prose(1, 50), prose(2, 30_000), "x" * 50_000, "\n\n\n"]
