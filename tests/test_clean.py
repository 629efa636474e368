from __future__ import annotations

from conftest import rows, ts

from orderloom.operators import clean, orders


def test_na_keys_and_null_keys_go(spark):
    df = spark.createDataFrame([("NA",), (None,), ("a",)], "order_id string")
    assert rows(clean.drop_na_keys(df)) == [("a",)]
    numbers = spark.createDataFrame([(1,), (None,)], "order_id bigint")
    assert rows(clean.drop_na_keys(numbers)) == [(1,)]


def test_text_times_that_do_not_parse_become_null(spark):
    df = spark.createDataFrame([("NA",), ("2021-03-28 02:30:00",), (None,)], "t string")
    cast = clean.cast_times(df, {"t": "time"})
    assert cast.columns == ["time"]
    # 02:30 on this day does not exist in zones that change the clock then
    assert rows(cast) == [(ts("2021-03-28 02:30:00"),), (None,), (None,)]


def test_time_range_includes_both_bounds(spark):
    first, last = orders.TRAINING_WINDOW
    times = ["2020-06-30 23:59:59", first, last, "2022-07-01 00:00:00", None]
    df = spark.createDataFrame([(ts(t),) for t in times], "t timestamp_ntz")
    assert rows(clean.in_time_range(df, "t", first, last)) == [(ts(first),), (ts(last),)]


def test_dedupe_compares_whole_rows(spark):
    df = spark.createDataFrame([(1, "p", 2.0), (1, "p", 2.0), (1, "p", 3.0)], "o int, p string, x double")
    assert rows(clean.dedupe(df)) == [(1, "p", 2.0), (1, "p", 3.0)]


def test_nonpositive_rows_need_all_columns(spark):
    df = spark.createDataFrame([(0.0, -1.0), (0.0, 1.0), (None, 0.0), (1.0, 1.0)], "p double, s double")
    assert rows(clean.nonpositive_rows(df, ["p", "s"])) == [(0.0, -1.0)]


def test_missing_days_and_incomplete_rows(spark):
    df = spark.createDataFrame(
        [(1, 2.0, None, 3.0, "x"), (2, 1.0, 1.0, 1.0, None), (3, 1.0, 1.0, 1.0, "y")],
        "k int, estimated_delivery_days double, order_to_approval_days double, "
        "actual_delivered_days double, status string",
    )
    filled = clean.fill_missing_days(df)
    assert rows(filled, "k", "order_to_approval_days", "status") == [
        (1, 99999.0, "x"), (2, 1.0, None), (3, 1.0, "y"),
    ]
    assert rows(clean.drop_incomplete(filled), "k") == [(1,), (3,)]
    assert rows(clean.drop_incomplete(df, ["status"]), "k") == [(1,), (3,)]
    assert rows(clean.all_present(df), "k") == rows(clean.drop_incomplete(df), "k") == [(3,)]


def test_missing_and_present_split_the_rows(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "k int, v int")
    assert rows(clean.rows_missing(df, "v"), "k") == [(1,)]
    assert rows(clean.rows_having(df, "v"), "k") == [(2,)]


def test_drop_ignores_case(spark):
    df = spark.createDataFrame([(1, 2)], "k int, Review_Class int")
    assert df.drop("review_class").columns == ["k"]
