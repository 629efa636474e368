"""What the optimizer makes of the operators: shuffles, pruning, pushed filters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from orderloom.operators import basetable, clean, items, payments, profile, reviews
from orderloom.plans.queries import _reviews
from orderloom.sources import standin


@pytest.fixture
def shuffled(spark):
    """Plans as for large tables: no broadcast by size, no adaptive wrapper."""
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def prepared(spark, folder):
    stats = items.ItemStats({"product_weight_g": 1.0}, "SMALL", ("LARGE", "SMALL"))
    source = standin.order_items(spark, folder), standin.products(spark, folder)
    return items.prepare_items(*source, stats), stats


def test_items_are_shuffled_once_and_read_by_order(spark, folder, shuffled):
    """One whole-row shuffle makes the bucketed table; nothing above its scan exchanges items."""
    whole = plan(standin.order_items(spark, folder).dropDuplicates())
    assert whole.count("Exchange hashpartitioning") == 1
    shared = items.shared_items(standin.order_items(spark, folder))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # products are small
    stats = items.ItemStats({"product_weight_g": 1.0}, "SMALL", ("LARGE", "SMALL"))
    base = items.prepare_items(shared, standin.products(spark, folder), stats)
    text = plan(items.items_per_order(base, stats.categories))
    assert "Bucketed: true" in text and "hashpartitioning(order_id" not in text
    # what is left deals out products, to drop their copies
    assert all("product_id" in line and "order_id" not in line for line in text.splitlines() if "Exchange hashpartitioning" in line)
    assert "Exchange" not in plan(clean.dedupe(shared))


def test_payments_take_one_shuffle(spark, folder, shuffled):
    text = plan(payments.payments_per_order(standin.order_payments(spark, folder)))
    assert text.count("Exchange") == 1 and "hashpartitioning(order_id" in text
    assert "min_payment_value" not in text
    spread = plan(payments.payment_facts(standin.order_payments(spark, folder), spread=True))
    assert spread.count("Exchange") == 2


def test_unused_category_columns_are_pruned(spark, folder, shuffled):
    base, stats = prepared(spark, folder)
    text = plan(items.items_per_order(base, stats.categories).select("order_id", "total_items"))
    assert "amount" not in text and "l_extendedprice" in text  # price is part of what makes a row distinct


def test_latest_review_joins_on_order_and_time(spark, folder, shuffled):
    text = plan(reviews.latest_reviews(_reviews(spark, folder)))
    assert "SortMergeJoin" in text and "Window" not in text
    # order and time both place a row, so one order's rows spread by time
    assert any("hashpartitioning" in line and line.count("coalesce") >= 1 for line in text.splitlines())


def test_base_table_uses_inner_joins(spark, folder, shuffled):
    base, stats = prepared(spark, folder)
    given = standin.training_tables(spark, folder)
    parts = basetable.prepare_parts(given, stats, standin.TRAINING)
    text = plan(basetable.complete_rows(parts))
    joins = [line for line in text.splitlines() if "SortMergeJoin" in line]
    # two sides, the latest reviews, reviews to sides, sums to category columns; the list of tied orders comes by a left join
    assert sum("Inner" in line for line in joins) == 5 and sum("LeftOuter" in line for line in joins) >= 2  # items find their products
    assert "SinglePartition" not in text and "Broadcast" not in text
    # tied orders come from the exchange that found the latest reviews, not from a pass of their own
    assert text.count("FileScan parquet [event_id") == 2
    assert not any("CartesianProduct" in line or "NestedLoop" in line for line in text.splitlines())


def test_null_profile_is_one_scan(spark, folder, shuffled):
    text = plan(profile.null_counts(standin.orders(spark, folder)))
    assert text.count("FileScan") == 1


def test_scan_reads_only_what_is_used(spark, folder, shuffled):
    text = plan(standin.order_payments(spark, folder).select("order_id"))
    assert "ReadSchema: struct<l_orderkey:bigint>" in text


def test_filter_reaches_the_scan(spark, folder, shuffled):
    text = plan(standin.order_payments(spark, folder).where(F.col("payment_value") > 5))
    assert "GreaterThan(l_extendedprice,5.0)" in text


def test_ties_of_one_order_are_split_at_run_time(spark):
    """A third of all reviews share order and time; adaptive execution splits them."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.0",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    df = spark.range(0, 60_000, 1, 8).selectExpr(
        "md5(string(id)) AS review_id",
        "if(id % 3 = 0, -1, id) AS order_id",
        "timestamp_ntz'2021-01-01' + make_dt_interval(if(id % 3 = 0, 1, int(id % 7))) AS review_answer_time",
    )
    for name, value in changed.items():
        spark.conf.set(name, value)
    try:
        latest = reviews.latest_reviews(df).groupBy().agg(F.count("review_id"))
        assert latest.collect()[0][0] == 60_000
        assert "SortMergeJoin(skew=true)" in plan(latest)
    finally:
        for name in changed:
            spark.conf.unset(name)
