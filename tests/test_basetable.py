from __future__ import annotations

from conftest import rows, ts
from pyspark.sql import functions as F

from orderloom.operators import basetable, clean, items, reports
from orderloom.operators.orders import TRAINING_WINDOW
from orderloom.sources import schemas
from orderloom.sources.tables import OrderTables


def tables(spark, with_reviews=True):
    def order(key, delivered="2021-01-15 10:00:00"):
        return (key, "delivered", "2021-01-10 10:00:00", "2021-01-11 10:00:00", "2021-01-12 10:00:00",
                delivered, "2021-01-20 00:00:00")

    full = [f"full{n}" for n in range(3)]
    raw_orders = [order(k) for k in full] + [
        order("no payment"), order("no items"), order("not delivered", "NA"), order("not reviewed"), order("NA"),
    ]
    paid = full + ["no items", "not delivered", "not reviewed", "unknown order"]
    sold = full + ["no payment", "not delivered", "not reviewed", "unknown order"]
    reviewed = full + ["no payment", "no items", "not delivered", "unknown order"]
    product = ("p", 10, 100, 1, 5, 1, 1, 1, "x")
    review_rows = [(f"r-{k}", k, 1 + n % 5, ts("2021-02-01"), "2021-02-03 09:00:00") for n, k in enumerate(reviewed)]
    review_rows.append(("r-tie", "full0", 5, ts("2021-02-01"), "2021-02-03 09:00:00"))
    return OrderTables(
        orders=spark.createDataFrame(raw_orders, schemas.ORDERS),
        order_items=spark.createDataFrame([(k, 1, "p", 10.0, 1.0) for k in sold], schemas.ORDER_ITEMS),
        products=spark.createDataFrame([product], schemas.PRODUCTS),
        order_payments=spark.createDataFrame([(k, 1, "card", 1, 11.0) for k in paid], schemas.ORDER_PAYMENTS),
        order_reviews=spark.createDataFrame(review_rows, schemas.ORDER_REVIEWS) if with_reviews else None,
    )


def parts(spark, rows_per_task=1_000_000, with_reviews=True):
    given = tables(spark, with_reviews)
    stats = items.fit_item_stats(given.order_items, given.products)
    return basetable.prepare_parts(given, stats, TRAINING_WINDOW, rows_per_task=rows_per_task)


def test_left_joins_keep_every_review(spark):
    joined = basetable.join_parts(parts(spark))
    assert joined.count() == 8
    assert joined.where("order_status IS NULL").count() == 1
    assert rows(basetable.incomplete_rows_count(joined)) == [(8, 4)]


def test_training_rows_are_the_complete_ones(spark):
    given = parts(spark)
    out = basetable.build_basetable(given)
    assert rows(out, "review_id") == [("r-full0",), ("r-full1",), ("r-full2",), ("r-tie",)]
    late = clean.drop_incomplete(clean.fill_missing_days(basetable.join_parts(given)))
    assert rows(out) == rows(late, *out.columns)
    assert basetable.training_basetable(tables(spark), unique_reviews=True).count() == 3


def test_missing_days_survive_with_a_subset(spark):
    out = basetable.build_basetable(parts(spark), ["order_status", "payment_type", "total_amount"])
    kept = {r.order_id: r.estimated_delivery_days for r in out.collect()}
    assert kept["not delivered"] == 99999.0 and kept["full0"] == 5.0
    assert set(kept) == {"full0", "full1", "full2", "not delivered"}


def test_holdout_has_no_review_columns(spark):
    given = tables(spark, with_reviews=False)
    stats = items.fit_item_stats(given.order_items, given.products)
    out = basetable.holdout_basetable(given, stats, TRAINING_WINDOW)
    assert rows(out, "order_id") == [("full0",), ("full1",), ("full2",), ("not reviewed",)]
    assert "label" not in out.columns and "review_id" not in out.columns
    everything = basetable.join_parts(parts(spark, with_reviews=False))
    assert rows(basetable.incomplete_rows_count(everything)) == [(7, 3)]


def test_salting_changes_nothing_but_the_plan(spark):
    plain, salted = parts(spark), parts(spark, rows_per_task=1)
    for build in (basetable.join_parts, basetable.complete_rows):
        assert rows(build(salted)) == rows(build(plain))


def test_a_tied_order_is_dealt_out(spark):
    """A third of all reviews tie for one order; a task gets a share of them."""
    reviews = spark.range(0, 30_000, 1, 8).selectExpr(
        "md5(string(id)) AS review_id", "if(id % 3 = 0, 'hot', string(id)) AS order_id",
        "if(id % 3 = 0, 10000L, 1L) AS review_ties",
    )
    sides = spark.range(30_000).selectExpr("string(id) AS order_id", "id AS v").union(
        spark.createDataFrame([("hot", -1)], "order_id string, v bigint"))
    tied = spark.createDataFrame([("hot", 10_000)], "order_id string, review_ties bigint")
    joined = basetable._to_reviews(reviews, sides, tied, "inner", 500)
    assert joined.count() == 30_000 and joined.where("v = -1").count() == 10_000
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 3 * 30_000 / len(sizes) and len(sizes) > 1
    assert "SinglePartition" not in plan and "Broadcast" not in plan


def test_reports(spark):
    out = basetable.build_basetable(parts(spark))
    # scores 1, 2, 3 and the tie's 5
    assert rows(reports.review_score_by(out, "DeliveryTimeStatus")) == [("early", 4, 2.75)]
    assert rows(reports.average_price_by_score(out)) == [
        (score, "early", 1, 10.0) for score in (1, 2, 3, 5)
    ]
