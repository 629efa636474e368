from __future__ import annotations

import pytest
from conftest import ts
from pyspark.sql import functions as F

from orderloom.functions import calendar as cal


def evaluate(spark, values, expression, kind="timestamp_ntz"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_time_of_day_bounds(spark):
    hours = [5, 6, 11, 12, 17, 18, 19, 20]
    times = [ts(f"2021-05-03 {h:02d}:59:59") for h in hours] + [None]
    assert evaluate(spark, times, cal.time_of_day) == [
        "night", "morning", "morning", "afternoon", "afternoon", "evening", "evening", "night", "night",
    ]


# 2023-01-01 was a Sunday
DAYS = [ts("2023-01-01"), ts("2023-01-05"), ts("2023-01-06"), ts("2023-01-07"), None]


def test_shifted_week(spark):
    assert evaluate(spark, DAYS, cal.day_name) == ["Monday", "Friday", "Saturday", "Sunday", "Sunday"]
    assert evaluate(spark, DAYS, cal.weekday_flag) == [
        "weekday", "weekday", "weekend", "weekend", "weekend",
    ]


def test_calendar_week(spark):
    names = evaluate(spark, DAYS, lambda c: cal.day_name(c, "calendar"))
    assert names == ["Sunday", "Thursday", "Friday", "Saturday", "Sunday"]
    flags = evaluate(spark, DAYS, lambda c: cal.weekday_flag(c, "calendar"))
    assert flags == ["weekend", "weekday", "weekday", "weekend", "weekend"]
    with pytest.raises(ValueError):
        cal.day_name(F.lit(None), "other")


def test_months(spark):
    times = [ts("2023-01-31"), ts("2023-06-01"), ts("2023-11-30"), ts("2023-12-01"), None]
    assert evaluate(spark, times, cal.month_name) == ["January", "June", "November", "December", "December"]


def test_delivery_status(spark):
    assert evaluate(spark, [1, 0, -1, None], cal.delivery_status, "int") == [
        "early", "timely", "delayed", "timely",
    ]


def test_days_between_counts_calendar_days(spark):
    df = spark.sql("SELECT timestamp_ntz'2021-03-02 00:01:00' a, timestamp_ntz'2021-03-01 23:59:00' b")
    assert df.select(cal.days_between(F.col("a"), F.col("b"))).first()[0] == 1
