"""Near-duplicates by SimHash fingerprints and an index on their bytes."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from orderloom.llm.components import components
from orderloom.llm.stages import attach, stage

#: Byte positions as the points 0 to 6 of two Fano planes that share no line, and point 7.
_LINES = [frozenset((sign * d + i) % 7 for d in (0, 1, 3)) for sign in (1, -1) for i in range(7)]
#: Four byte positions per posting list: lines with point 7, and what lines leave of the
#: other points. Of the 14 sets of a plane exactly one avoids any three positions, so two
#: fingerprints share ``LEAST_SHARED`` postings if five bytes are equal, more if more are,
#: and one at most if four are.
POSTINGS = tuple(tuple(sorted(line | {7})) for line in _LINES) + tuple(tuple(sorted(set(range(7)) - line)) for line in _LINES)
#: Fewest postings that two fingerprints with three differing bytes share.
LEAST_SHARED = 2
MAX_BITS = 3
#: Posting lists up to this length are joined with themselves and tallied; longer ones are
#: linked through centres, at a cost in proportion to their length.
LONG_LIST = 64
#: A document is hashed in runs of this many words, to bound memory.
_RUN = 1 << 18


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The 64-bit SimHash of one text, as a signed number.

    A-Z become lower case, words are runs of anything but ASCII white space, shingles
    are ``width`` words with repeats. A text of fewer words is one shingle; a null text
    or one without words has fingerprint zero.
    """
    import xxhash

    hash64 = xxhash.xxh64_intdigest
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _RUN):
        run = words[at : at + min(_RUN, n - at) + width - 1]
        shingles = zip(*(run[i:] for i in range(width))) if len(words) >= width else [run]
        hashes = np.array([hash64(b" ".join(s), seed) for s in shingles], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprint_column(text: Column, width: int = 3, seed: int = 42) -> Column:
    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width, seed) for t in texts], dtype="int64")

    return of(text)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bytes(fp: Column, places) -> Column:
    """The bytes of a fingerprint at some places, as one number; the rest is zero."""
    return fp.bitwiseAND(F.lit(_signed(sum(0xFF << (8 * p) for p in places))))


def _ball(places, radius: int) -> list[int]:
    """All masks of up to ``radius`` bits within some bytes."""
    bits = [8 * p + i for p in places for i in range(8)]
    return [_signed(sum(1 << b for b in c)) for r in range(radius + 1) for c in combinations(bits, r)]


def links(fingerprints: DataFrame, fp: str = "fp", long_list: int = LONG_LIST) -> DataFrame:
    """(a, b) pairs of distinct fingerprints that connect all within three bits of each other.

    Every fingerprint is posted under 28 sets of four positional bytes. Postings that a
    pair shares are tallied, pairs that reach the guaranteed minimum are kept (it takes
    five equal bytes), and verified by counting bits. Two fingerprints of one long posting
    list are not paired there: they agree outside four bytes, so each goes to all values
    within two bits of it there, and at every value that some member is within one bit of,
    all meet that member (two and one are three bits at most). Any two within three bits
    meet such a value, so components stay exact and the rows grow with the list, not its
    square. A pair whose tally misses a long list is linked by that list already.
    """
    posts = stage(
        fingerprints.select(F.col(fp).alias("fp")).distinct().select(
            "fp",
            F.posexplode(F.array(*[_bytes(F.col("fp"), s) for s in POSTINGS])).alias("posting", "key"),
        ),
        "postings",
    )
    sizes = posts.groupBy("posting", "key").agg(F.count("*").alias("n"))
    long_keys = stage(sizes.where(F.col("n") > long_list).select("posting", "key"), "long-postings")
    short = posts.join(long_keys, ["posting", "key"], "left_anti")
    left, right = short.withColumnRenamed("fp", "a"), short.withColumnRenamed("fp", "b")
    shared = left.join(right, ["posting", "key"]).where("a < b")
    tally = shared.groupBy("a", "b").agg(F.count("*").alias("n_shared")).where(F.col("n_shared") >= LEAST_SHARED)
    pairs = tally.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS).select("a", "b")

    balls = [" ".join(map(str, _ball(sorted(set(range(8)) - set(s)), 2))) for s in POSTINGS]
    masks = F.transform(F.split(F.lit(",".join(balls)), ","), lambda b: F.split(b, " ").cast("array<bigint>"))
    spread = posts.join(long_keys, ["posting", "key"], "left_semi").select(
        "fp", "posting", F.explode(F.element_at(masks, F.col("posting") + 1)).alias("mask"),
    ).select("fp", "posting", F.col("fp").bitwiseXOR(F.col("mask")).alias("value"), (F.bit_count("mask") <= 1).alias("near"))
    centres = spread.where("near").groupBy("posting", "value").agg(F.min("fp").alias("centre"))
    starred = spread.join(centres, ["posting", "value"]).select(
        F.least("fp", "centre").alias("a"), F.greatest("fp", "centre").alias("b")
    ).where("a < b")
    return pairs.union(starred).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", fp: str = "fp", long_list: int = LONG_LIST) -> DataFrame:
    """One row per document: (id, fp, component_id, component_size, keeper_fp).

    ``docs`` holds ids and signed fingerprints and should be a stage table. Documents of
    equal fingerprint are one node from the start, so copies are never paired. The
    component id is the smallest document id reachable; an id that is null is never the
    smallest unless it is alone. ``keeper_fp`` is the smallest fingerprint that has the
    component id, so id and fingerprint together name one text of a component, without ids
    too. Rows with a null fingerprint are left out.
    """
    groups = stage(
        docs.where(F.col(fp).isNotNull()).groupBy(F.col(fp).alias("fp"))
        .agg(F.min(id_col).alias("first_id"), F.count("*").alias("n_same")),
        "fingerprints",
    )
    roots = components(links(groups, "fp", long_list), "a", "b")
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    first = F.min(F.struct(F.col("first_id").isNull().alias("without"), "first_id", "fp"))
    whole = rooted.groupBy("root").agg(first.alias("first"), F.sum("n_same").alias("component_size"))
    found = rooted.join(whole, "root").select("fp", F.col("first.first_id").alias("component_id"), "component_size", F.col("first.fp").alias("keeper_fp"), "n_same")
    labelled = stage(found, "labels")
    rows = docs.select(F.col(id_col), F.col(fp).alias("fp"))
    return attach(rows, labelled, "fp", "n_same").drop("n_same")
