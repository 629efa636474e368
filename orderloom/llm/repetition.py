"""Quality rules on repeated words and lines, by rolling hashes in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

BASE_WINDOW = 5
#: Largest share of word characters inside n-grams that occur twice or more. Below the
#: fifth of the words that the base rule allows, else they could not reject anything.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of word characters inside lines that occur twice or more.
LINE_COVERAGE = 0.2
LEAST_WORDS = 10
SYMBOLS = "#*$%&|<>"
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
FIELDS = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, dup_line_chars bigint, dup_gram_chars array<bigint>"


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ (keys >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ (keys >> np.uint64(29))


def _repeated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    out = np.zeros(len(keys), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out


def _covered(starts: np.ndarray, n: int, width: int) -> np.ndarray:
    """Which of n words lie in a window of ``width`` words that begins at a marked start."""
    steps = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(starts)
    np.add.at(steps, at, 1)
    np.add.at(steps, at + width, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(text: str | None, widths=tuple(COVERAGE)) -> tuple:
    """The figures of one whole text, in the order of ``FIELDS``.

    Words are runs of anything but ASCII white space. The window hash of n words rolls:
    it is the hash of n - 1 words times an odd factor plus the next word's key.
    """
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    chars = np.fromiter((len(w) if w.isascii() else len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, n)
    symbols = sum(map(text.count, SYMBOLS))
    lines: dict[bytes, int] = {}
    repeats = dup_line_chars = 0
    if b"\n" in raw:
        for line in raw.split(b"\n"):
            own = line.split()
            if own:
                seen = lines.get(line, 0)
                lines[line] = seen + 1
                repeats += seen > 0
        for line, times in lines.items():
            if times > 1:
                dup_line_chars += times * sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split())
    repeat_words, covered = 0, []
    if n >= BASE_WINDOW:
        keys = _mixed(np.fromiter(map(hash, words), np.int64, n).view(np.uint64))
        rolled, have = keys, 1
        for width in sorted({BASE_WINDOW, *widths}):
            while have < width and len(rolled) > 1:
                rolled = rolled[:-1] * _FACTOR + keys[have:]
                have += 1
            starts = _repeated(rolled) if have == width else np.zeros(1, bool)
            if not starts.any():
                covered += [0] * (len(widths) - len(covered))
                break  # longer windows repeat only where shorter ones do
            inside = _covered(starts, n, width)
            if width == BASE_WINDOW:
                repeat_words = int(inside.sum())
            if width in widths:
                covered.append(int(chars[inside].sum()))
    covered += [0] * (len(widths) - len(covered))
    return n, int(chars.sum()), symbols, repeats, repeat_words, dup_line_chars, covered


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", coverage: dict[int, float] | None = None, line_coverage: float = LINE_COVERAGE) -> DataFrame:
    """One row per document with its figures, base_failed, fails and kept.

    ``fails`` lists the rules of the method that a document breaks: ``line`` for the
    characters in repeated lines, ``5`` .. ``10`` for those in repeated n-grams. A
    document is kept if the base rules hold and none is broken. A null or empty text has
    no words and fails the base rules. Rows are judged one by one; no shuffle.
    """
    limits = COVERAGE if coverage is None else coverage
    widths = tuple(sorted(limits))

    @F.pandas_udf(FIELDS)
    def of(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t, widths) for t in texts], columns=[f.split()[0] for f in FIELDS.split(", ")])

    found = docs.select(F.col(id_col), of(F.col(text_col)).alias("m")).select(id_col, "m.*")
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    broken = [F.when(F.col("dup_line_chars") > line_coverage * F.col("word_chars"), "line")] + [
        F.when(F.col("dup_gram_chars")[i] > limits[w] * F.col("word_chars"), str(w)) for i, w in enumerate(widths)
    ]
    return found.withColumn("base_failed", base).withColumn("fails", F.array_compact(F.array(*broken))).withColumn(
        "kept", ~F.col("base_failed") & (F.size("fails") == 0)
    )
