"""Exact duplicates through an extendible-hash index; built-in functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.stages import attach, stage

WHITE_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
#: Texts a bucket may hold before the directory splits it.
BUCKET_ROWS = 200_000
#: The directory has at most two to this power entries.
MAX_DEPTH = 16
#: What a null id counts as.
LAST_ID = 2**63 - 1


def normalised(text: Column) -> Column:
    """A text without its ASCII white space; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE_SPACE, "")


def prefix(key: Column, depth: int) -> Column:
    """The first ``depth`` bits of a 64-bit key."""
    return F.lit(0).cast("int") if depth == 0 else F.shiftrightunsigned(key, 64 - depth).cast("int")


def directory(counts: dict[int, int], depth: int, capacity: int) -> list[int]:
    """Bucket number of every prefix of ``depth`` bits.

    ``counts`` has the texts per prefix. The directory starts with one bucket and doubles
    until no bucket holds more than ``capacity`` or the depth is reached: an overfull
    bucket splits on its next bit, others stay shared by several entries. Buckets are
    numbered in key order.
    """
    held = [counts.get(p, 0) for p in range(1 << depth)]
    buckets, entries = 0, [0] * (1 << depth)
    waiting = [(0, 1 << depth)]
    while waiting:
        low, high = waiting.pop()
        if high - low > 1 and sum(held[low:high]) > capacity:
            middle = (low + high) // 2
            waiting += [(middle, high), (low, middle)]
            continue
        entries[low:high] = [buckets] * (high - low)
        buckets += 1
    return entries


def text_key(norm: Column, key_bits: int = 64) -> Column:
    """The 64-bit key of a normalised text; fewer leading bits make keys collide."""
    return F.xxhash64(norm).bitwiseAND(F.lit(-(1 << (64 - key_bits)) if key_bits else 0).cast("bigint"))


def _grouped(rows: DataFrame) -> DataFrame:
    """One row per normalised text of (norm, rank): key, digest, group_size, keep_points, keep_id."""
    unit, last = _units()
    return rows.groupBy("key", "norm").agg(F.count("*").alias("group_size"), F.max("rank").alias("rank")).select(
        "key", "norm", F.sha2("norm", 256).alias("digest"), "group_size",
        F.floor(F.col("rank") / unit).cast("bigint").alias("keep_points"), (last - F.col("rank") % unit).cast("bigint").alias("keep_id"),
    )


def _units() -> tuple[Column, Column]:
    return F.lit(str(10**20)).cast("decimal(21,0)"), F.lit(LAST_ID).cast("decimal(20,0)")


def _rank(text: Column, own_id: Column) -> Column:
    """Longest first, then smallest id, as one number that a hash aggregation can hold."""
    unit, last = _units()
    return (F.length(text).cast("decimal(10,0)") * unit + (last - F.coalesce(own_id, F.lit(LAST_ID)).cast("decimal(20,0)"))).cast("decimal(38,0)")


def _texts(docs: DataFrame, id_col: str, text_col: str, key_bits: int) -> DataFrame:
    text, norm = F.coalesce(F.col(text_col), F.lit("")), normalised(F.col(text_col))
    return docs.select(text_key(norm, key_bits).alias("key"), norm.alias("norm"), _rank(text, F.col(id_col)).alias("rank"))


@dataclass(frozen=True)
class Index:
    """The directory, and the bucket table: one row per different normalised text.

    ``table`` has bucket, key, digest (SHA-256 of the text), chain (0 for the first text of
    a key, 1, 2 .. for texts that collide with it), chained (texts of the key), keep_id,
    keep_points, group_size. ``entries`` has the bucket of every prefix of ``depth`` bits.
    """

    table: DataFrame
    entries: tuple[int, ...]
    depth: int

    def bucket(self, key: Column) -> Column:
        """Look a key's prefix up in the directory."""
        return _pointer(self.entries, self.depth, key)


def _pointer(entries: Sequence[int], depth: int, key: Column) -> Column:
    return F.element_at(F.split(F.lit(",".join(map(str, entries))), ",").cast("array<int>"), prefix(key, depth) + 1)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS, key_bits: int = 64) -> Index:
    """The index on shared files.

    Copies are combined inside each scan task before anything is shuffled, and texts are
    grouped by their bytes, not by a hash of them. The directory comes from a histogram of
    key prefixes (at most 65,536 counts); each bucket is a range of keys that one task
    owns, sorts and chains.
    """
    texts = stage(_grouped(_texts(docs, id_col, text_col, key_bits)).drop("norm"), "texts")
    counts = {r["p"]: r["n"] for r in texts.groupBy(prefix(F.col("key"), MAX_DEPTH).alias("p")).agg(F.count("*").alias("n")).collect()}
    depth = min(MAX_DEPTH, max(0, (sum(counts.values()) // bucket_rows).bit_length() + 3))
    coarse: dict[int, int] = {}
    for p, n in counts.items():
        coarse[p >> (MAX_DEPTH - depth)] = coarse.get(p >> (MAX_DEPTH - depth), 0) + n
    entries = directory(coarse, depth, bucket_rows)
    owned = texts.withColumn("bucket", _pointer(entries, depth, F.col("key"))).repartition(max(entries) + 1, "bucket")
    of_key = Window.partitionBy("bucket", "key")
    table = stage(
        owned.select(
            "bucket", "key", "digest", (F.row_number().over(of_key.orderBy("digest")) - 1).alias("chain"), F.count("*").over(of_key).alias("chained"),
            "keep_id", "keep_points", "group_size",
        ),
        "index",
    )
    return Index(table, tuple(entries), depth)


def probe(docs: DataFrame, index: Index, id_col: str = "doc_id", text_col: str = "text", key_bits: int = 64) -> DataFrame:
    """(id, points, digest, keep_id, keep_points, group_size) of every document, found by bucket, key and chain.

    A key with one text in its chain is that text's: the document itself was grouped by
    its bytes under that key. Where a chain has more, documents go along it and compare
    bytes: the texts of such keys, and of no others, are read once more.
    """
    norm = normalised(F.col(text_col))
    own = docs.select(
        F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("points"), text_key(norm, key_bits).alias("key")
    )
    probes = stage(own.withColumn("bucket", index.bucket(F.col("key"))), "probes")
    found = ["digest", "keep_id", "keep_points", "group_size"]
    alone = index.table.where("chained = 1").select("bucket", "key", *found)
    met = attach(probes, alone, ["bucket", "key"], "group_size").select("id", "points", *found)
    collided = index.table.where("chained > 1").groupBy("key").agg(F.sum("group_size").alias("n"))
    if collided.isEmpty():
        return met
    collided = stage(collided, "collided")
    text = docs.select(
        F.col(id_col).alias("id"), F.length(F.coalesce(F.col(text_col), F.lit(""))).cast("bigint").alias("points"),
        text_key(norm, key_bits).alias("key"), norm.alias("norm"), _rank(F.coalesce(F.col(text_col), F.lit("")), F.col(id_col)).alias("rank"),
    )
    walking = stage(attach(text, collided, "key", "n").drop("n"), "walking")
    links = stage(_grouped(walking.select("key", "norm", "rank")), "chains")
    return met.unionByName(attach(walking.drop("rank"), links, ["key", "norm"], "group_size").select("id", "points", *found))


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS, key_bits: int = 64
) -> DataFrame:
    """One row per document: (id, keep_id, group_size, kept, text_sha256, points).

    Texts are equal when identical without ASCII white space; null is empty. The longest
    original text stays, then the smallest id. Repeated rows of one id are each listed;
    of equal length they share the decision. A null id counts as the largest one.
    """
    met = probe(docs, build_index(docs, id_col, text_col, bucket_rows, key_bits), id_col, text_col, key_bits)
    kept = (F.coalesce("id", F.lit(LAST_ID)) == F.col("keep_id")) & (F.col("points") == F.col("keep_points"))
    keep_id = F.when(F.col("keep_id") != LAST_ID, F.col("keep_id"))
    return met.select(
        F.col("id").alias(id_col), keep_id.alias("keep_id"), "group_size", kept.alias("kept"), F.col("digest").alias("text_sha256"), "points"
    )
