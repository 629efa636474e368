"""Review-score reports over the base table; groups are few, so partials do the work."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from orderloom.functions import money


def review_score_by(basetable: DataFrame, group: str) -> DataFrame:
    """(group, reviews, average_review_score)."""
    return basetable.groupBy(group).agg(
        F.count("*").alias("reviews"), F.avg("review_score").alias("average_review_score")
    )


def review_scores_by(basetable: DataFrame, groups: Sequence[str]) -> DataFrame:
    """(report, value, reviews, average_review_score): several reports from one pass over the base table."""
    sets = basetable.groupingSets([[g] for g in groups], *groups).agg(
        F.grouping_id().alias("id"), F.count("*").alias("reviews"), F.avg("review_score").alias("average_review_score")
    )
    # Of the bits of the grouping id, first column first, that of the one column in use is 0.
    every = (1 << len(groups)) - 1
    used = {g: every ^ (1 << (len(groups) - 1 - i)) for i, g in enumerate(groups)}
    name, value = F.lit(None).cast("string"), F.lit(None).cast("string")
    for g, own in used.items():
        name = F.when(F.col("id") == own, g).otherwise(name)
        value = F.when(F.col("id") == own, F.col(g).cast("string")).otherwise(value)
    return sets.select(name.alias("report"), value.alias("value"), "reviews", "average_review_score")


def average_price_by_score(basetable: DataFrame) -> DataFrame:
    """Mean of the orders' average price per review score and delivery status."""
    sums = (
        basetable.withColumn("units", money.units("average_price"))
        .groupBy("review_score", "DeliveryTimeStatus")
        .agg(
            F.count("*").alias("reviews"),
            F.sum("units").alias("total"),
            F.count("units").alias("n"),
        )
    )
    return sums.withColumn("average_price", money.mean_to_cents("total", "n")).drop("total", "n")
