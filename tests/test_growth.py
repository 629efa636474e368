"""What a task holds and how often rows are made, whatever the size of the tables."""

from __future__ import annotations

import pytest

from orderloom import session
from orderloom.operators import basetable, items, payments
from orderloom.plans.queries import REGISTRY, _training_parts
from orderloom.sources import schemas, standin


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_what_one_task_gathers_does_not_grow_with_the_table(spark, folder, monkeypatch):
    """More bytes mean more tasks, for payments and for the bucketed items."""
    assert session.tasks_for(standin.order_payments(spark, folder)) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    unknown = spark.createDataFrame(spark.sparkContext.parallelize([(1,)]), "a int")
    assert session.tasks_for(unknown) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = session.estimated_bytes(standin.order_payments(spark, folder))
    assert session.tasks_for(standin.order_payments(spark, folder), size // 20) >= 20
    monkeypatch.setattr(payments, "tasks_for", lambda df: 23)
    monkeypatch.setattr(session, "tasks_for", lambda df: 29)
    assert "hashpartitioning(order_id#" in (text := plan(payments.payments_per_order(standin.order_payments(spark, folder)))) and ", 23)" in text
    shared = items.shared_items(standin.order_items(spark, folder))
    assert "SelectedBucketsCount: 29 out of 29" in plan(shared.groupBy("order_id").count())


def test_a_task_holds_a_small_part_of_a_large_table(spark, folder, monkeypatch):
    monkeypatch.setattr(session, "estimated_bytes", lambda df: 200 << 20)
    assert session.tasks_for(standin.order_payments(spark, folder)) == 100


def test_split_makes_its_rows_once(spark, folder):
    """Both sides read stored rows; nothing is joined or gathered for a side of its own."""
    text = plan(REGISTRY["split_train_test"](spark, folder))
    assert "Join" not in text and "Exchange" not in text


def test_order_costs_gather_items_in_buckets(spark, folder):
    text = plan(REGISTRY["order_cost_rollup"](spark, folder))
    assert "Bucketed: true" in text and "hashpartitioning(order_id" not in text


@pytest.fixture
def plain_plans(spark):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {name: spark.conf.get(name) for name in changed}
    for name, value in changed.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def test_base_table_reads_items_once_and_leaves_sides_in_place(spark, folder, plain_plans):
    """One aggregate over the bucketed items; what is gathered by order is not exchanged again."""
    parts = _training_parts(spark, folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10m")  # products are small
    text = plan(parts.items)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert text.count("Bucketed: true") == 1 and "pivot" not in text.lower()
    whole = plan(basetable.complete_rows(parts))
    assert "salt" not in whole
    gathered = [line for line in whole.splitlines() if "Exchange hashpartitioning(" in line]
    assert not any("total_price" in line or "pmod" in line for line in gathered)


def test_sides_are_dealt_out_where_an_order_has_many_reviews(spark, folder):
    given = basetable.with_shared_items(standin.training_tables(spark, folder))
    stats = basetable.fit_shared_stats(given)
    few = basetable.prepare_parts(given, stats, standin.TRAINING)
    many = basetable.prepare_parts(given, stats, standin.TRAINING, rows_per_task=1)
    assert few.tied is None and many.tied is not None
    one, two = (basetable.complete_rows(p) for p in (few, many))
    assert one.exceptAll(two).isEmpty() and two.exceptAll(one).isEmpty() and not one.isEmpty()


def test_one_pass_gives_the_columns_of_two(spark):
    """Amounts that are no whole cents, missing ones, unknown products, other categories and no order."""
    rows = [
        (1, 1, "a", 1.25, 0.1), (1, 1, "a", 1.25, 0.1), (1, 2, "b", 0.333, None), (1, 3, "a", 2.0, 0.004),
        (2, 1, "c", 5.0, 1.0), (2, 2, "unknown", None, 1.0), (None, 1, "a", 1.0, 1.0), (3, 1, "b", None, None),
    ]
    given = spark.createDataFrame(rows, "order_id int, order_item_id int, product_id string, price double, shipping_cost double")
    products = spark.createDataFrame(
        [("a", 3, 20, 1, 7, 1, 1, 1, "x"), ("b", 4, None, 2, 5, 1, 1, 1, "it's"), ("c", 5, 30, 4, None, 1, 1, 1, "other")],
        schemas.PRODUCTS,
    )
    shared = items.shared_items(given)
    assert sorted(map(str, shared.collect())) == sorted(map(str, given.dropDuplicates().collect()))
    stats = items.fit_item_stats(shared, products, dedupe_items=False)
    assert stats == items.fit_item_stats(given, products)
    names = ("x", "it's", "absent")
    one = items.items_per_order(items.prepare_items(shared, products, stats, dedupe_items=False), names, one_pass=True)
    two = items.items_per_order(items.prepare_items(given, products, stats), names)
    assert one.schema.names == two.schema.names and one.dtypes == two.dtypes
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect())) and one.count() == 3


def test_holdout_vectors_fit_the_statistics_once(spark, folder, monkeypatch):
    fits = []
    fit = items.fit_item_stats
    for module in (items, basetable):
        monkeypatch.setattr(module, "fit_item_stats", lambda *args, **options: fits.append(1) or fit(*args, **options))
    REGISTRY["encode_pipeline"](spark, folder)
    assert len(fits) == 1
