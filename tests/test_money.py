from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.functions import money


def summed(spark, values):
    terms = spark.createDataFrame([(v,) for v in values], "price double").select(money.units("price").alias("u"))
    return terms.agg(F.sum("u").alias("total"), F.count("u").alias("n")).select(
        money.to_cents("total").alias("total"), money.mean_to_cents("total", "n").alias("mean"), "n"
    ).first()


def test_nulls_and_what_is_no_number_count_for_nothing(spark):
    assert tuple(summed(spark, [1.25, None, float("nan"), float("inf"), -float("inf"), 2.5])) == (3.75, 1.88, 2)
    assert tuple(summed(spark, [None])) == (None, None, 0)


def test_numbers_that_fit_no_term_are_refused(spark):
    assert summed(spark, [9e17, -9e17, 0.01])["total"] == 0.01
    for value in (1e18, -1e18, 1e300):
        with pytest.raises(Exception, match="price is too large"):
            summed(spark, [1.0, value])


def exact(spark, values):
    given = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, price double")
    parts = given.select(money.cents("price").alias("c"), money.rest("price").alias("r"), money.units("price").alias("u"))
    sums = parts.agg(F.sum("c").alias("c"), F.sum("r").alias("r"), (F.count("c") + F.count("r")).alias("n"), F.sum("u").alias("u"))
    return sums.select(
        money.sum_to_cents("c", "r").alias("total"), money.sum_mean_to_cents("c", "r", "n").alias("mean"), money.sum_unrounded("c", "r").alias("plain"),
        money.to_cents("u"), money.mean_to_cents("u", "n"), money.unrounded("u"), "n",
    ).first()


@pytest.mark.parametrize("values", [
    [1.25, None, float("nan"), float("inf"), -float("inf"), 2.5],
    [None], [float("nan")], [0.0, -0.0], [-0.01, -0.02], [0.01, 0.02], [0.005, 0.01], [0.125, 0.37, -5.0],
    [9e17, -9e17, 0.01], [21474836.47, 21474836.48, 1e9], [1 / 3, 2 / 3, 1e-11, 0.1 + 0.2], [901.13] * 7,
    [21474836.47] * 500, [1234567.891, -0.005], [-1.0, 1.0],
])
def test_cents_and_the_rest_say_what_one_decimal_sum_says(spark, values):
    total, mean, plain, *same, _ = exact(spark, values)
    assert [total, mean, plain] == same


def test_whole_cents_are_no_decimals(spark):
    """What most amounts are is added as longs; decimals are left for other values."""
    given = spark.createDataFrame([(v,) for v in (12.34, 0.07, 33.0, 0.125, 1e9)], "price double")
    assert [tuple(r) for r in given.select(money.cents("price"), money.rest("price").isNull()).collect()] == [
        (1234, True), (7, True), (3300, True), (None, False), (None, False)
    ]
