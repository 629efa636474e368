"""Metrics of scored tables, as one-row-per-metric DataFrames."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window, functions as F

from orderloom.session import cut_lineage


def area(
    scored: DataFrame,
    metric: str = "areaUnderROC",
    score: str = "rawPrediction",
    label: str = "label",
    bins: int = 0,
) -> float:
    """Area under the ROC or PR curve, over every distinct score unless ``bins`` thins them."""
    return BinaryClassificationEvaluator(
        metricName=metric, rawPredictionCol=score, labelCol=label, numBins=bins
    ).evaluate(scored)


def shares(scored: DataFrame, prediction: str = "prediction", label: str = "label") -> dict[str, float]:
    """``accuracy``, and ``f1``: the F1 of each class weighted by its rows.

    Both follow from one count per label and prediction.
    """
    counts = {
        (float(r[0]), float(r[1])): r[2]
        for r in scored.groupBy(label, prediction).agg(F.count("*")).collect()
    }
    total = sum(counts.values())
    if not total:
        return {"accuracy": 0.0, "f1": 0.0}
    hits = {c: counts.get((c, c), 0) for c in {c for pair in counts for c in pair}}
    f1 = 0.0
    for c, hit in hits.items():
        actual = sum(n for (own, _), n in counts.items() if own == c)
        said = sum(n for (_, own), n in counts.items() if own == c)
        f1 += actual / total * 2 * hit / (actual + said)
    return {"accuracy": sum(hits.values()) / total, "f1": f1}


def share(
    scored: DataFrame, metric: str, prediction: str = "prediction", label: str = "label"
) -> float:
    return shares(scored, prediction, label)[metric]


#: Ranges of scores whose counts are summed first.
CURVE_RANGES = 1000


def score_ranges(per_score: DataFrame, ranges: int = CURVE_RANGES) -> DataFrame:
    """``per_score`` with ``place``: which of about ``ranges`` ranges, alike in rows, a threshold is in.

    Bounds are approximate quantiles, from sketches that are merged, so crowded scores get
    narrow ranges. They are the one thing that comes to the driver.
    """
    wanted = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    bounds = per_score.agg(F.percentile_approx("threshold", wanted, F.lit(20 * ranges))).first()[0] or []
    splits = [float("-inf"), *(sorted(set(bounds)) or [0.0]), float("inf")]
    return Bucketizer(splits=splits, inputCol="threshold", outputCol="place").transform(per_score)


def curve_points(scored: DataFrame, score: str = "score", label: str = "label", ranges: int = CURVE_RANGES) -> DataFrame:
    """(threshold, pos, neg, tp, fp, all_pos, all_neg) of every distinct score, counted from the highest down.

    Counts are summed over ranges of scores first, then inside each range, so no task
    sees all scores. Rows without a score are left out.
    """
    per_score = cut_lineage(
        scored.select(F.col(score).cast("double").alias("threshold"), F.col(label).cast("bigint").alias("own")).where("threshold IS NOT NULL")
        .groupBy("threshold").agg(F.sum("own").alias("pos"), F.count("*").alias("n"))
        .select("threshold", "pos", (F.col("n") - F.col("pos")).alias("neg"))
    )
    placed = score_ranges(per_score, ranges)
    inside = Window.partitionBy("place").orderBy(F.desc("threshold"))
    above = Window.orderBy(F.desc("place")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    sums = placed.groupBy("place").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).select(
        "place", F.coalesce(F.sum("p").over(above), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum("q").over(above), F.lit(0)).alias("neg_above"),
        F.sum("p").over(every).alias("all_pos"), F.sum("q").over(every).alias("all_neg"),
    )
    return placed.join(F.broadcast(sums), "place").select(
        "threshold", "pos", "neg", (F.col("pos_above") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("neg_above") + F.sum("neg").over(inside)).alias("fp"), "all_pos", "all_neg",
    )


def curves(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(curve, threshold, x, y): the ROC and precision-recall points of every distinct score."""
    points = curve_points(scored, score, label)
    rate = F.try_divide("tp", "all_pos")
    roc = points.select(F.lit("roc").alias("curve"), "threshold", F.try_divide("fp", "all_neg").alias("x"), rate.alias("y"))
    pr = points.select(F.lit("pr").alias("curve"), "threshold", rate.alias("x"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("y"))
    return roc.unionByName(pr)


def rank_sum_area(scored: DataFrame, score: str = "score", label: str = "label") -> float:
    """Area under the ROC curve as the rank sum of the positives, equal scores sharing a rank.

    From the points of the curve: a positive beats the negatives below it and half of
    those beside it. Whole numbers are summed, so nothing depends on the order of rows.
    """
    points = curve_points(scored, score, label)
    big = lambda c: F.col(c).cast("decimal(18,0)")
    beaten = big("pos") * (2 * (big("all_neg") - big("fp")) + big("neg"))
    twice, pos, neg = points.agg(F.sum(beaten.cast("decimal(38,0)")), F.max("all_pos"), F.max("all_neg")).first()
    return float(twice) / (2 * pos * neg) if pos and neg else 0.0


def as_table(like: DataFrame, values: Mapping[str, float]) -> DataFrame:
    rows = [(name, float(value)) for name, value in values.items()]
    return like.sparkSession.createDataFrame(rows, "metric string, value double")


def evaluate(scored: DataFrame) -> DataFrame:
    """All four metrics of a model's predictions."""
    return as_table(scored, {
        "area_under_roc": area(scored),
        "area_under_pr": area(scored, "areaUnderPR"),
        **shares(scored),
    })
