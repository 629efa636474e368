"""Mixing sources to target weights by hash-random order and distributed prefix sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.llm.stages import stage

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Leading hex digits of the random key that name a range of keys: 4,096 ranges a source.
RANGE_DIGITS = 3


def words(text: Column) -> Column:
    """Number of runs of anything but ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def random_key(id_col: str, seed: int) -> Column:
    """A document's place in the random order; depends on its id and the seed only."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(str(seed))).cast("binary"))


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    Sources in code point order, null last, get the weights in turn. They share the sum of
    all sizes; a target stops at ``most`` times its source's size, and the excess is
    shared anew by weight. The sources that stop are the first ones by size over weight,
    so two running sums over the sources find them all.
    """
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    ratio = Window.orderBy(F.col("source_size") / F.col("weight"), F.asc_nulls_last("source"))
    before, everything = ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    size, most_size = F.col("source_size"), F.lit(most) * F.col("source_size")
    left = F.sum(size).over(everything) - F.coalesce(F.sum(most_size).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    stops = (most_size * weight_left) < (F.col("weight") * left)
    found = sources.withColumn("weight", weight.cast("bigint")).withColumn("stops", stops)
    shared = F.sum(size).over(everything) - F.sum(F.when(F.col("stops"), most_size).otherwise(0)).over(everything)
    shared_weight = F.sum(F.when(F.col("stops"), 0).otherwise(F.col("weight"))).over(everything)
    target = F.when(F.col("stops"), most_size.cast("double")).otherwise((shared * F.col("weight")).cast("double") / shared_weight)
    return found.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_EPOCHS,
    seed: int = 7,
    range_digits: int = RANGE_DIGITS,
) -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target, mix_passes and mix_cut.

    A document is taken ``mix_passes`` times whole, and then ``mix_cut`` of its words: all
    of them before its source's cut in the random order, a part at the cut, none behind
    it. Ids and sizes are dealt out by source and range of the random key, sorted inside
    each range, and summed there; sums of ranges give what stands before each. Only the
    range of the cut needs its own prefix sums, so a source with a third of all rows is
    spread over 4,096 ranges. Texts are not shuffled: the cuts come back as one row per
    source. Documents of one id in one source share a place in the order; at the cut they
    share what is left. Null ids and null sources are values like others; a null or empty
    text has size 0 and is never taken in part. Reruns agree.
    """
    key = random_key(id_col, seed)
    sized = stage(docs.select(F.col(source_col).alias("source"), key.alias("key"), words(F.col(text_col)).alias("size")), "sizes")
    ranges = sized.groupBy("source", F.substring("key", 1, range_digits).alias("range")).agg(F.sum("size").alias("range_size"))
    ranges = stage(ranges, "ranges")
    plan = targets(ranges.groupBy("source").agg(F.sum("range_size").alias("source_size")), weights, most)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    plan = plan.withColumn("passes", passes).withColumn(
        "rest", F.greatest(F.lit(0), F.floor("target") - F.col("passes") * F.col("source_size")).cast("bigint")
    )
    plan = stage(plan, "sources")

    same = lambda a, b: F.col(f"{a}.source").eqNullSafe(F.col(f"{b}.source"))
    running = Window.partitionBy("source").orderBy("range")
    summed = ranges.withColumn("until", F.sum("range_size").over(running))
    cut_range = summed.alias("r").join(plan.alias("p"), same("r", "p")).where("until > rest and until - range_size <= rest").select(
        F.col("r.source").alias("source"), "range", (F.col("rest") - F.col("until") + F.col("range_size")).alias("rest_in_range")
    )
    inside = sized.withColumn("range", F.substring("key", 1, range_digits)).alias("s").join(
        cut_range.alias("c"), same("s", "c") & (F.col("s.range") == F.col("c.range"))
    ).select("s.source", "key", "size", "rest_in_range")
    places = inside.groupBy("source", "key", "rest_in_range").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    in_range = Window.partitionBy("source").orderBy("key")
    cut = places.withColumn("until", F.sum("size").over(in_range)).where("until > rest_in_range and until - size <= rest_in_range").select(
        "source", F.col("key").alias("cut_key"), ((F.col("rest_in_range") - F.col("until") + F.col("size")) / F.col("n")).cast("bigint").alias("cut_words")
    )
    decided = plan.alias("p").join(cut.alias("c"), same("p", "c"), "left").select(
        F.col("p.source").alias("mix_source"), F.col("source_size").alias("mix_source_size"),
        F.col("target").alias("mix_target"), F.col("passes").alias("mix_passes"), "cut_key", "cut_words",
    )
    decided = stage(decided, "cuts")
    own = docs.withColumn("mix_size", words(F.col(text_col))).withColumn("mix_key", key)
    extra = F.when(F.col("mix_key") < F.col("cut_key"), F.col("mix_size")).when(
        F.col("mix_key") == F.col("cut_key"), F.least("mix_size", "cut_words")
    ).otherwise(0)
    return (
        own.join(decided, F.col(source_col).eqNullSafe(F.col("mix_source")), "left")
        .withColumn("mix_cut", extra.cast("bigint")).drop("mix_source", "mix_key", "cut_key", "cut_words")
    )


def repeated(mixed: DataFrame) -> DataFrame:
    """The mix as rows: every document as often as it is taken, whole.

    The document at the cut is taken once more if half of it or more lies before the cut.
    """
    more = ((F.col("mix_cut") > 0) & (2 * F.col("mix_cut") >= F.col("mix_size"))).cast("bigint")
    times = F.col("mix_passes") + more
    own = [c for c in mixed.columns if not c.startswith("mix_")]
    return mixed.where(times > 0).withColumn("mix_pass", F.explode(F.sequence(F.lit(1), times.cast("int")))).select(*own)
