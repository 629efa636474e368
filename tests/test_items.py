from __future__ import annotations

import itertools

from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import basetable, clean, items, profile
from orderloom.sources import schemas, standin

PRODUCTS = [
    # id, name, description, photos, weight, length, height, width, category
    ("p1", 10, 100, 1, 5, 1, 1, 1, "x"),
    ("p2", 10, 100, 1, 5, 1, 1, 1, "x"),
    ("p3", 20, 101, 2, 6, 1, 1, 1, "y"),
    ("p4", None, None, None, None, None, None, None, None),
    ("p5", 99, 999, 9, 9, 9, 9, 9, "never sold"),
]
ITEMS = [
    ("o1", 1, "p1", 10.0, 1.0),
    ("o1", 1, "p1", 10.0, 1.0),  # whole-row copy
    ("o1", 2, "p3", 20.0, None),  # no shipping cost
    ("o2", 1, "p4", 5.25, 0.25),
    ("o2", 2, "p2", 1.0, 1.0),
    ("o3", 1, "missing", 7.0, 2.0),
    ("o3", 1, "missing", 8.0, 2.0),  # same item at another price
]


def tables(spark, item_rows=ITEMS, product_rows=PRODUCTS):
    return (
        spark.createDataFrame(item_rows, schemas.ORDER_ITEMS),
        spark.createDataFrame(product_rows, schemas.PRODUCTS),
    )


def test_stats(spark):
    stats = items.fit_item_stats(*tables(spark))
    # distinct values of sold products only: 10, 20
    assert stats.means["product_name_lenght"] == 15.0
    assert stats.means["product_description_lenght"] == 100.5
    assert stats.mode == "x" and stats.categories == ("x", "y")


def test_stats_by_rows(spark):
    stats = items.fit_item_stats(*tables(spark), distinct_means=False)
    assert abs(stats.means["product_name_lenght"] - 40 / 3) < 1e-12  # 10, 10, 20


def test_mode_counts_items_once_and_breaks_ties_by_name(spark):
    source = tables(spark, [("o", 1, "p3", 1.0, 1.0), ("o", 1, "p3", 1.0, 1.0), ("o", 2, "p1", 1.0, 1.0)])
    assert items.fit_item_stats(*source).mode == "x"
    assert items.fit_item_stats(*source, dedupe_items=False).mode == "y"


def test_mode_ignores_missing_categories(spark):
    source = tables(spark, [("o", n, "p4", 1.0, 1.0) for n in range(5)] + [("o", 9, "p3", 1.0, 1.0)])
    assert items.fit_item_stats(*source).mode == "y"


def test_fraction_is_cut_in_whole_number_columns(spark):
    filled = items.fit_item_stats(*tables(spark)).fill(tables(spark)[1])
    p4 = filled.where("product_id = 'p4'").first()
    assert (p4.product_name_lenght, p4.product_description_lenght) == (15, 100)
    assert p4.product_category_name == "x"
    assert dict(filled.dtypes)["product_description_lenght"] == "int"


def test_prepared_items_are_complete_and_distinct(spark):
    source = tables(spark)
    prepared = items.prepare_items(*source, items.fit_item_stats(*source))
    assert prepared.count() == prepared.distinct().count() == 6
    missing = prepared.where("product_id = 'missing'").select("product_name_lenght").distinct()
    assert rows(missing) == [(15,)]


def test_repeated_products_collapse_like_a_dedupe_after_the_join(spark):
    repeated = PRODUCTS + [PRODUCTS[0], ("p3", 20, 101, 2, 6, 1, 1, 1, "z"), ("p3", 20, None, 2, 6, 1, 1, 1, "y")]
    order_items, products = tables(spark, ITEMS, repeated)
    stats = items.fit_item_stats(order_items, products)
    late = stats.fill(order_items.dropDuplicates().join(products, "product_id", "left")).dropDuplicates()
    prepared = items.prepare_items(order_items, products, stats)
    assert rows(prepared.select(*late.columns)) == rows(late)


def test_rollup(spark):
    source = tables(spark)
    stats = items.fit_item_stats(*source)
    out = {r.order_id: r for r in items.items_per_order(items.prepare_items(*source, stats), stats.categories).collect()}
    o1, o2, o3 = out["o1"], out["o2"], out["o3"]
    assert (o1.total_items, o1.total_price, o1.total_shipping_cost, o1.total_amount) == (2, 30.0, 1.0, 31.0)
    # the item without shipping cost adds nothing to its category
    assert (o1.total_amount_x, o1.total_amount_y) == (11.0, 0.0)
    assert (o1.average_price, o1.average_shipping_cost) == (15.0, 1.0)
    assert o1.average_product_description_lenght == 100.5
    assert (o2.total_amount_x, o2.average_price) == (7.5, 3.13)  # 3.125 rounds up
    assert (o3.total_items, o3.total_price) == (2, 15.0)


def test_money_rounds_half_up_from_exact_sums(spark):
    source = tables(spark, [("a", 1, "p1", 0.005, -0.005), ("a", 2, "p1", 0.015, -0.005), ("b", 1, "p1", float("nan"), None)])
    out = items.order_costs(items.prepare_items(*source, items.fit_item_stats(*source)))
    a, b = out.orderBy("order_id").collect()
    assert (a.total_price, a.average_price) == (0.02, 0.01)
    assert (a.total_shipping_cost, a.average_shipping_cost) == (-0.01, -0.01)
    assert (b.total_price, b.average_price, b.total_amount) == (None, None, None)


def test_absent_category_gets_a_column_of_zeros(spark):
    source = tables(spark)
    stats = items.fit_item_stats(*source)
    wide = items.category_amounts(items.prepare_items(*source, stats), ("x", "absent"))
    assert wide.columns == ["order_id", "total_amount_x", "total_amount_absent"]
    assert rows(wide, "total_amount_absent") == [(0.0,)] * 3


def test_any_number_of_categories(spark):
    products = [(f"p{n}", n, 1, 1, 1, 1, 1, 1, f"c{n % 12_000:05}") for n in range(12_500)]
    source = tables(spark, [("o", n, f"p{n}", 1.0, 1.0) for n in range(12_500)], products)
    stats = items.fit_item_stats(*source, wide=False)
    assert stats.mode == "c00000" and stats.categories == ()
    long = items.category_amounts_long(items.prepare_items(*source, stats))
    assert rows(long.groupBy("amount").count()) == [(2.0, 11_500), (4.0, 500)]
    assert len(items.fit_item_stats(*source).categories) == 12_000


def test_odd_category_names(spark):
    names = ["home.garden", "Art", "art", "a`b", "", "Art_2"]
    products = [(f"p{n}", 1, 1, 1, 1, 1, 1, 1, c) for n, c in enumerate(names)]
    source = tables(spark, [("o", n, f"p{n}", float(n), 0.0) for n in range(len(names))], products)
    stats = items.fit_item_stats(*source)
    wide = items.items_per_order(items.prepare_items(*source, stats), stats.categories)
    made = [c for c in wide.columns if c.startswith(items.AMOUNT_PREFIX)]
    assert len({c.lower() for c in made}) == len(made) == len(names)
    assert rows(profile.null_counts(wide), "null_count") == [(0,)] * len(wide.columns)
    assert clean.all_present(wide).count() == 1
    assert sorted(wide.select(*[F.col(clean.quoted(c)) for c in made]).first()) == [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]
    assert rows(basetable.incomplete_rows_count(wide)) == [(1, 0)]


def test_fine_and_large_amounts(spark):
    source = tables(spark, [("a", n, "p1", 0.00004, 0.0) for n in range(50)] + [("b", n, "p1", 3e14 + n, 0.5) for n in range(4)]
                    + [("c", 1, "p1", float("inf"), 1.0)])
    stats = items.fit_item_stats(*source)
    out = {r.order_id: r for r in items.items_per_order(items.prepare_items(*source, stats), ("x",)).collect()}
    assert (out["a"].total_amount_x, out["a"].total_price) == (0.002, 0.0)
    assert (out["b"].total_price, out["b"].average_price) == (1_200_000_000_000_006.0, 300_000_000_000_001.5)
    assert out["c"].total_price is None and out["c"].total_shipping_cost == 1.0


def test_whole_measures_of_a_double_column_are_cut(spark):
    order_items, products = tables(spark)
    wide = products.withColumn("product_description_lenght", F.col("product_description_lenght").cast("double"))
    half = wide.withColumn("product_description_lenght", F.col("product_description_lenght") + 0.25)
    for given, want in ((wide, 100.0), (half, 100.75)):
        filled = items.fit_item_stats(order_items, given).fill(given)
        assert filled.where("product_id = 'p4'").first().product_description_lenght == want


def test_fused_rollup_equals_joined_rollups(spark, folder):
    source = standin.order_items(spark, folder), standin.products(spark, folder)
    stats = items.fit_item_stats(*source)
    prepared = items.prepare_items(*source, stats)
    fused = items.items_per_order(prepared, stats.categories)
    joined = (
        items.items_counted(prepared)
        .join(items.order_costs(prepared), "order_id", "left")
        .join(items.category_amounts(prepared, stats.categories), "order_id", "left")
    )
    assert rows(joined.select(*fused.columns)) == rows(fused)
    assert fused.select("order_id").distinct().count() == fused.count()


def test_category_amounts_agree_with_long_form(spark, folder):
    source = standin.order_items(spark, folder), standin.products(spark, folder)
    stats = items.fit_item_stats(*source)
    prepared = items.prepare_items(*source, stats)
    wide = items.category_amounts(prepared, stats.categories)
    names = wide.columns[1:]
    total = sum(wide.agg(*[F.sum(n).alias(n) for n in names]).first())
    rows_total = prepared.agg(F.sum(F.col("price") + F.col("shipping_cost"))).first()[0]
    assert abs(total - rows_total) < 1e-3


def test_result_does_not_depend_on_partitions(spark):
    source = tables(spark)
    stats = items.fit_item_stats(*source)
    results = [
        rows(items.items_per_order(
            items.prepare_items(source[0].repartition(a), source[1].repartition(b), stats), stats.categories))
        for a, b in itertools.product((1, 5), (1, 3))
    ]
    assert all(r == results[0] for r in results)


def test_items_of_a_hot_order_are_not_bucketed(spark):
    spread = spark.range(3000).selectExpr(
        "concat('o', id) AS order_id", "id AS order_item_id", "id % 7 AS product_id", "double(id % 5) AS price", "double(id % 2) AS shipping_cost",
    )
    hot = spread.withColumn("order_id", F.expr("if(order_item_id % 3 = 0, 'hot', order_id)"))
    hot = hot.unionByName(hot.where("order_item_id < 4"))  # copies
    assert profile.has_hot_key(hot, "order_id", 0) and not profile.has_hot_key(spread, "order_id", 0)
    assert not profile.has_hot_key(hot, "order_id") and not profile.has_hot_key(hot.limit(0), "order_id", 0)
    bucketed, plain = items.shared_items(hot), items.shared_items(hot, safe_bytes=0)
    is_bucketed = lambda df: "Bucketed:" in df._jdf.queryExecution().executedPlan().toString()
    assert is_bucketed(bucketed) and not is_bucketed(plain) and is_bucketed(items.shared_items(spread, safe_bytes=0))
    described = lambda df: df.withColumns({items.CATEGORY: F.lit("A"), **{name: F.lit(1.0) for name in items.AVERAGED_MEASURES}})
    one, two = (rows(items.items_per_order(described(df), ("A",))) for df in (bucketed, plain))
    assert one == two and len(one) == 2001
