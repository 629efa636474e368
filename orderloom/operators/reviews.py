"""Reviews: answer times, the latest review of each order, label and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import calendar
from orderloom.operators import clean
from orderloom.operators.profile import group_counts

TIMES = {"review_answer_timestamp": "review_answer_time"}
# Fixed value: scores from here on count as positive.
POSITIVE_FROM = 4


def fill_answer_time(reviews: DataFrame) -> DataFrame:
    """A missing answer time becomes midnight of the day after the survey was sent."""
    next_day = F.date_add("review_creation_date", 1)
    kind = reviews.schema["review_answer_time"].dataType
    return reviews.withColumn(
        "review_answer_time", F.coalesce("review_answer_time", next_day.cast(kind))
    )


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    return group_counts(reviews, "order_id", "review_id", "review_count")


def review_count_histogram(reviews: DataFrame) -> DataFrame:
    """How many orders have one review, two reviews, and so on."""
    return group_counts(reviews_per_order(reviews), "review_count", "order_id", "order_count")


def attach_review_count(reviews: DataFrame) -> DataFrame:
    """Each review with the number of reviews of its order; none for reviews without a key.

    Reviews are counted per order and time, then per order, and the count comes back on
    order and time together, so that the rows of a busy order are spread by time.
    """
    known, at = reviews.where(F.col("order_id").isNotNull()), "review_answer_time"
    per_time = known.groupBy("order_id", at).agg(F.count("review_id").alias("n"))
    per_order = per_time.groupBy("order_id").agg(F.sum("n").alias("review_count"))
    places = per_time.join(per_order, "order_id").select(
        F.col("order_id").alias("counted_order"), F.col(at).alias("counted_time"), "review_count"
    )
    counted = known.join(
        places, (F.col("order_id") == F.col("counted_order")) & F.col(at).eqNullSafe(F.col("counted_time"))
    ).select(*reviews.columns, "review_count")
    without_key = reviews.where(F.col("order_id").isNull()).withColumn("review_count", F.lit(None).cast("bigint"))
    return counted.unionByName(without_key)


TIES = "review_ties"


def newest_times(reviews: DataFrame) -> DataFrame:
    """(order_id, newest, review_ties) per order: the latest answer time and its row count.

    Reviews are combined per order and time before any shuffle. An order with one
    review is listed even without a time.
    """
    at = "review_answer_time"
    per_time = reviews.where(F.col("order_id").isNotNull()).groupBy("order_id", at).agg(
        F.count("*").alias("n_rows"), F.count("review_id").alias("n_reviews")
    )
    return (
        per_time.groupBy("order_id")
        .agg(
            F.max(at).alias("newest"), F.sum("n_reviews").alias("n"),
            F.max_by("n_rows", at).alias("n_newest"), F.sum("n_rows").alias("n_all"),
        )
        .where((F.col("n") == 1) | F.col("newest").isNotNull())
        .select("order_id", "newest", F.coalesce("n_newest", "n_all").alias(TIES))
    )


def latest_with_ties(reviews: DataFrame) -> DataFrame:
    """The reviews with the latest answer time of their order, and how many tie there.

    They are found again by a join on order and time together. The rows of an order
    with very many reviews are thus spread by time, where a window would sort them all
    in one task.
    """
    newest = newest_times(reviews).withColumnRenamed("order_id", "newest_order")
    return reviews.join(
        newest,
        (F.col("order_id") == F.col("newest_order"))
        & F.col("review_answer_time").eqNullSafe(F.col("newest")),
    ).select(*reviews.columns, TIES)


def latest_reviews(reviews: DataFrame) -> DataFrame:
    """The reviews with the latest answer time of their order; ties all stay."""
    return latest_with_ties(reviews).drop(TIES)


def latest_review_unique(reviews: DataFrame) -> DataFrame:
    """Exactly one review per order: the latest, and of equals the largest review_id."""
    rest = [c for c in reviews.columns if c not in ("order_id", "review_answer_time", "review_id")]
    ranked = F.struct("review_answer_time", "review_id", *rest)
    best = reviews.where(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.max(ranked).alias("best"))
    return best.select("order_id", "best.*").select(*reviews.columns)


def single_and_latest(reviews: DataFrame) -> DataFrame:
    """Orders with one review as they are, united with the latest of the others.

    Gives the rows of ``latest_reviews``, with the review count kept as a column.
    """
    counted = attach_review_count(reviews)
    single = counted.where(F.col("review_count") == 1)
    several = counted.where(F.col("review_count") != 1)
    return single.unionByName(latest_reviews(several))


def label(score: Column) -> Column:
    """1 for a positive review and for one without a score, 0 for a negative one."""
    return F.when(score < POSITIVE_FROM, 0).otherwise(1)


def add_review_features(reviews: DataFrame, convention: str = "shifted") -> DataFrame:
    answered = F.col("review_answer_time")
    return reviews.withColumns({
        "label": label(F.col("review_score")),
        "DaysTakenForReview": calendar.days_between(answered, F.col("review_creation_date")),
        "review_time_of_day": calendar.time_of_day(answered),
        "review_weekend_or_weekday": calendar.weekday_flag(answered, convention),
        "day_of_the_week": calendar.day_name(answered, convention),
        "month": calendar.month_name(answered),
    })


def timed_reviews(raw: DataFrame) -> DataFrame:
    """Raw reviews with their answer time as a timestamp, filled where it is missing."""
    return fill_answer_time(clean.cast_times(raw, TIMES))


def prepare_reviews(
    raw: DataFrame, unique: bool = False, convention: str = "shifted"
) -> DataFrame:
    """Raw reviews to one row per order (or per tie), with label and features."""
    return prepare_reviews_with_ties(raw, unique, convention).drop(TIES)


def prepare_reviews_with_ties(raw: DataFrame, unique: bool = False, convention: str = "shifted") -> DataFrame:
    """``prepare_reviews`` with the number of reviews that tie for the latest of their order."""
    timed = timed_reviews(raw)
    kept = latest_review_unique(timed).withColumn(TIES, F.lit(1).cast("bigint")) if unique else latest_with_ties(timed)
    return add_review_features(kept, convention)
