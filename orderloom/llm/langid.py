"""Language identification by rank-order profiles of character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

UNKNOWN = "und"
#: N-grams in a profile, of a language or of a document.
PROFILE = 300
LONGEST = 3
#: Documents per language that profiles are learned from, about.
FIT_ROWS = 5_000
_SHARES = 1_000_000
_CHUNK = 1 << 20
#: Texts whose counts are held at once while learning.
_FIT_TEXTS = 500
#: Stands for a gap inside an n-gram; no letter has this number.
_GAP = 1


@cache
def _letters() -> np.ndarray:
    """Lower case code point of every letter, zero for all other code points."""
    table = np.zeros(0x110000, np.int64)
    for point in range(0x110000):
        letter = chr(point)
        if letter.isalpha():
            table[point] = ord(letter.lower()[0])
    return table


def _counted(grams: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weights is None:
        return np.unique(grams, return_counts=True)
    found, at = np.unique(grams, return_inverse=True)
    return found, np.bincount(at, weights, len(found)).astype(np.int64)


def grams(text: str | None, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams as numbers, counts) of a whole text.

    Letters in lower case, everything else a gap; n-grams of one to three letters or of
    letters next to a gap. Long texts are counted in chunks cut at white space.
    """
    text = text or ""
    if len(text) > _CHUNK:
        parts, at = [], 0
        while at < len(text):
            end = text.find(" ", at + _CHUNK)
            end = len(text) if end < 0 else end
            parts.append(_one(text[at:end], longest))
            at = end
        return _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
    return _one(text, longest)


def _one(text: str, longest: int) -> tuple[np.ndarray, np.ndarray]:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letters = np.concatenate(([0], _letters()[points], [0]))
    letters = letters[np.concatenate(([True], (letters[1:] != 0) | (letters[:-1] != 0)))]
    gap = letters == 0
    found = [letters[~gap]]
    code = letters = np.where(gap, _GAP, letters)
    for n in range(2, longest + 1):
        inner = np.ones(max(0, len(letters) - n + 1), bool)
        for i in range(1, n - 1):
            inner &= ~gap[i : i + len(inner)]
        code = (code[:-1] << 21) | letters[n - 1 :]
        if n == 2:
            inner &= ~(gap[:-1] & gap[1:])
        found.append(code[inner])
    return _counted(np.concatenate(found))


def top(found: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams, equal counts by number."""
    return found[np.lexsort((found, -counts))[:size]]


def held_out(id_col: str, folds: int = 5) -> Column:
    """Whether a document is kept from learning: CRC-32 of its id as text, modulo folds, is 0."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == 0


def fit(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    fit_rows: int = FIT_ROWS, size: int = PROFILE,
) -> dict[str, list[int]]:
    """The profile of every language: its most frequent n-grams in order.

    Learns from whole texts of labelled documents that are not held out: about
    ``fit_rows`` per language, chosen by a hash of the id. Counts are summed per task,
    then over tasks. What comes to the driver is one row per language and ``size`` rows
    per profile.
    """
    labelled = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col)).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")
    )
    shares = {r["lang"]: min(1.0, fit_rows / r["n"]) for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not shares:
        return {}
    share = F.element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
    sample = labelled.where(F.pmod(F.xxhash64("id"), F.lit(_SHARES)) < share * _SHARES)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                for at in range(0, len(texts), _FIT_TEXTS):
                    parts = [grams(t) for t in texts.iloc[at : at + _FIT_TEXTS]]
                    found, n = _counted(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]))
                    yield pd.DataFrame({"lang": lang, "gram": found, "n": n})

    counts = sample.select("text", "lang").mapInPandas(count, "lang string, gram bigint, n bigint")
    summed = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = summed.withColumn("rank", rank).where(F.col("rank") <= size).collect()
    profiles: dict[str, list[int]] = {}
    for row in sorted(best, key=lambda r: (r["lang"], r["rank"])):
        profiles.setdefault(row["lang"], []).append(row["gram"])
    return profiles


def ranks(profiles: dict[str, list[int]], size: int = PROFILE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(languages, all n-grams in order, rank of each in each language or -1)."""
    names = sorted(profiles)
    known = np.array(sorted({g for p in profiles.values() for g in p}), np.int64)
    table = np.full((len(known), len(names)), -1, np.int64)
    for j, name in enumerate(names):
        table[np.searchsorted(known, profiles[name]), j] = np.arange(len(profiles[name]))
    return names, known, table


def nearest(text: str | None, names: list[str], known: np.ndarray, table: np.ndarray, size: int = PROFILE) -> tuple[str, float]:
    """The language whose profile is least out of place, and 1 - distance / largest distance.

    An n-gram that a profile lacks counts as ``size`` places. Ties go to the first name.
    """
    found, counts = grams(text) if text else (np.zeros(0, np.int64),) * 2
    if not len(found) or not names:
        return UNKNOWN, 0.0
    own = top(found, counts, size)
    at = np.minimum(np.searchsorted(known, own), max(0, len(known) - 1))
    places = np.where((known[at] == own)[:, None], table[at], -1)
    apart = np.where(places >= 0, np.abs(places - np.arange(len(own))[:, None]), size).sum(axis=0)
    best = int(apart.argmin())
    return names[best], float(1 - apart[best] / (size * len(own)))


def predict(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score, from the whole text alone.

    ``und`` with score 0 if the text is null or has no letter, or nothing was learned.
    """
    names, known, table = ranks(profiles)

    @F.pandas_udf("lang_pred string, score double")
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([nearest(t, names, known, table) for t in texts], columns=["lang_pred", "score"])

    own = [F.col(f"`{c}`") for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(*own, of(F.col(text_col)).alias("guess")).select(*own, "guess.lang_pred", "guess.score")
