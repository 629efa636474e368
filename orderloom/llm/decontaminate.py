"""Benchmark decontamination: a hash set of test n-grams is scanned for; built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.ascii import ascii_lower
from orderloom.llm.stages import attach, likely, stage

#: Words of lower-cased text: ASCII letters and digits, and everything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: What stands between words in text as it was written, and a word there.
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
#: Above this many bytes of n-grams and item ids, windows are filtered by a bitmap of
#: fixed size and joined in a shuffle instead of a broadcast.
BROADCAST_BYTES = 32 << 20


def words(text: Column) -> Column:
    """The words of a text after lower-casing A-Z; null has none. Splitting costs a third of collecting matches."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAP, -1), "")


def word_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP, -1), "")).cast("bigint")


@dataclass(frozen=True)
class Grams:
    """The n-grams of a benchmark: a table (key, size, ngram, items), their lengths, and their bytes."""

    table: DataFrame
    sizes: tuple[int, ...]
    n_bytes: int


def benchmark_grams(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> Grams:
    """Every different n-gram of the items, with the sorted ids of the items that have it.

    An item of fewer words than ``window``, but not none, is one n-gram. Repeated items
    count once. An item without an id marks words but is not listed. Up to ``window``
    lengths and one sum come to the driver.
    """
    split = benchmark.select(F.col(id_col).cast("string").alias("item"), words(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    grams = split.select("item", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("words") - size), lambda i: F.struct(F.slice("words", i + 1, size).alias("gram")),
    )).alias("g")).select("item", F.col("g.gram").alias("gram"))
    table = stage(
        grams.groupBy("gram").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
            F.xxhash64("gram").alias("key"), F.size("gram").alias("size"), F.array_join("gram", " ").alias("ngram"), "items",
        ), "grams",
    )
    held = F.octet_length("ngram") + F.aggregate("items", F.lit(0), lambda acc, i: acc + F.octet_length(i))
    found = table.groupBy("size").agg(F.sum(held).alias("n_bytes")).collect()
    return Grams(table, tuple(sorted(r["size"] for r in found)), sum(r["n_bytes"] for r in found))


def hits(texts: DataFrame, grams: Grams, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(digest, place, size, items): every window of a text that is an n-gram of the benchmark.

    ``texts`` has digest and words. Windows are looked up by hash, and the words of those
    that are found are compared. Copies of a text, and of a window, are combined before
    anything is shuffled.
    """
    wanted = grams.table
    # Loops over lengths and places instead of arrays of windows, so that hashing and lookup
    # are compiled into them. Outer, because for the inner form Spark would first make all
    # windows once more in a filter.
    places = F.when(F.size("words") >= F.col("size"), F.sequence(F.lit(0), F.size("words") - F.col("size")))
    sized = texts.select("digest", "words", F.explode(F.array(*[F.lit(size) for size in grams.sizes]).cast("array<int>")).alias("size"))
    placed = sized.select("digest", "words", "size", F.explode_outer(places).alias("place")).where("place IS NOT NULL")
    own = F.slice("words", F.col("place") + 1, F.col("size"))
    key = F.xxhash64(own)
    if grams.n_bytes <= broadcast_bytes:
        # The words stay where they are. As an equality the comparison would become part of
        # the join key, made for every window.
        grams_there = F.broadcast(wanted.withColumnsRenamed({"key": "gram_key", "size": "gram_size"}))
        joined = placed.join(grams_there, (key == F.col("gram_key")) & (F.col("size") == F.col("gram_size")))
        met = joined.where(F.startswith(F.concat(F.array_join(own, " "), F.lit(" ")), F.concat("ngram", F.lit(" "))))
    else:
        scanned = placed.select("digest", "place", "size", key.alias("key"), F.array_join(own, " ").alias("own"))
        met = likely(scanned, wanted, "key").join(wanted, ["key", "size"]).where("own = ngram")
    return met.groupBy("digest", "place", "size").agg(F.first("items").alias("items"))


def found_texts(hit_windows: DataFrame) -> DataFrame:
    """(digest, spans, n_hit, items) per text with hits; spans are disjoint word ranges.

    Overlapping windows are merged by gaps and islands over a text's own windows.
    """
    upto = Window.partitionBy("digest").orderBy("place", "size")
    reach = F.max(F.col("place") + F.col("size")).over(upto.rowsBetween(Window.unboundedPreceding, -1))
    opened = hit_windows.withColumn("opens", (F.coalesce(reach, F.lit(-1)) < F.col("place")).cast("int"))
    islands = opened.withColumn("island", F.sum("opens").over(upto))
    merged = islands.groupBy("digest", "island").agg(
        F.min("place").alias("start"), F.max(F.col("place") + F.col("size")).alias("end"), F.collect_set("items").alias("lists"),
    )
    return merged.groupBy("digest").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.sum(F.col("end") - F.col("start")).alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.flatten(F.collect_list("lists"))))).alias("items"),
    )


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(id, digest, n_words, spans, n_hit, items), one row per row of ``docs``.

    spans are the ranges [start, end) of words inside any occurrence of an n-gram; items
    the sorted ids of the items with such an n-gram. Null and empty texts have no words;
    equal texts are scanned each and combined before the shuffle; ids may be null or
    repeat; other columns are not read. An empty benchmark hits nothing. A text of any
    length is one row: it is scanned window by window, and its windows are not stored.
    """
    grams = benchmark_grams(benchmark, item_col, item_text_col, window)
    texts = docs.select(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"), words(F.col(text_col)).alias("words"))
    found = stage(found_texts(hits(texts, grams, broadcast_bytes)), "found")
    probes = stage(
        docs.select(
            F.col(id_col).alias("id"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256).alias("digest"),
            word_count(F.col(text_col)).alias("n_words"),
        ), "probes",
    )
    sizes = probes.groupBy("digest").agg(F.count("*").alias("n"))
    groups = stage(sizes.join(found, "digest", "left"), "texts")
    met = attach(probes, groups, "digest", "n")
    return met.select(
        F.col("id").alias(id_col), "digest", "n_words",
        F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def remove_documents(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` without those whose text has a hit; ``found`` comes from ``contamination``.

    Digests of texts that go are distinct, so a text with many copies is split by Spark's
    handling of skewed joins.
    """
    gone = found.where("n_hit > 0").select("digest").distinct()
    return docs.join(gone, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256) == gone["digest"], "left_anti")


def without_spans(text: Column, spans: Column) -> Column:
    """A text without the words of some spans and what stands between them; the rest as written."""
    found = F.regexp_extract_all(text, F.lit(ANY_CASE_WORD), F.lit(0))
    gaps = F.split(text, ANY_CASE_WORD, -1)
    units = F.zip_with(gaps, found, lambda gap, word: F.concat(gap, F.coalesce(word, F.lit(""))))
    count = F.size(found)
    starts = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["end"].cast("int")))
    ends = F.concat(F.transform(spans, lambda s: s["start"].cast("int")), F.array(count + 1))
    # Between two spans: whole units, and of the unit that a span begins with what stands before its word.
    kept = F.zip_with(starts, ends, lambda a, b: F.concat(
        F.array_join(F.slice(units, a + 1, b - a), ""), F.when(b <= count, F.element_at(gaps, F.least(b, count) + 1)).otherwise(F.lit("")),
    ))
    return F.array_join(kept, "")


def remove_spans(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with hit spans cut out of their texts; texts without a hit are untouched.

    Only spans of texts that have some come back, one row per different text.
    """
    cuts = found.where("n_hit > 0").groupBy(F.col("digest").alias("_cut_digest")).agg(F.first("spans").alias("_cut_spans"))
    own = F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)
    met = docs.join(cuts, own == F.col("_cut_digest"), "left")
    text = F.when(F.col("_cut_spans").isNull(), F.col(text_col)).otherwise(without_spans(F.col(text_col), F.col("_cut_spans")))
    return met.withColumn(text_col, text).drop("_cut_digest", "_cut_spans")
