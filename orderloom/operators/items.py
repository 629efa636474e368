"""Items and products: imputation fitted once, then one row per order."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.functions import money
from orderloom.operators.clean import quoted
from orderloom.operators.profile import SAFE_BYTES, has_hot_key
from orderloom.session import bucketed_table, cut_lineage
from orderloom.sources.schemas import CATEGORY, PRODUCT_MEASURES

AMOUNT_PREFIX = "total_amount_"
AVERAGED_MEASURES = PRODUCT_MEASURES[:4]

@dataclass(frozen=True)
class ItemStats:
    """What imputation and the category columns need to know, fitted on training data.

    ``categories`` is filled only for the wide form, in which each becomes a column;
    ``whole`` names the measures that hold whole numbers only.
    """

    means: dict[str, float]
    mode: str | None
    categories: tuple[str, ...] = ()
    whole: tuple[str, ...] = ()

    def fill(self, df: DataFrame) -> DataFrame:
        """Fill measures with their means (cut to whole numbers where all values are whole,
        whatever the column's type) and a missing category with the most frequent one."""
        means = {name: float(int(mean)) if name in self.whole else mean for name, mean in self.means.items()}
        filled = df.na.fill(means) if means else df
        return filled if self.mode is None else filled.na.fill(self.mode, subset=[CATEGORY])


def shared_items(items: DataFrame, safe_bytes: int = SAFE_BYTES, tasks: int | None = None) -> DataFrame:
    """The distinct items as a table that is bucketed by order.

    Everything an order's items are used for reads this table: gathering by order needs no
    exchange then, since the rows of an order lie in one bucket. Equal rows do as well, so
    items are exchanged once, by order, and copies dropped where they meet. A large table
    in which one order holds much of all items (see ``has_hot_key``) is not bucketed:
    items are combined before each exchange then.
    """
    if has_hot_key(items, "order_id", safe_bytes):
        return cut_lineage(items.dropDuplicates())
    return bucketed_table(items, "order_id", "items", tasks, distinct=True)


def with_products(items: DataFrame, products: DataFrame) -> DataFrame:
    """Items with their product columns; items of unknown products stay."""
    return items.join(products, "product_id", "left")


def fit_item_stats(
    items: DataFrame,
    products: DataFrame,
    distinct_means: bool = True,
    dedupe_items: bool = True,
    wide: bool = True,
) -> ItemStats:
    """Means and most frequent category over items joined to products.

    Items are first counted per product, so the statistics work on a table of
    product size: a value's weight is its products' item count. Means are taken over
    the distinct values of a column unless ``distinct_means`` is off. Equal counts
    resolve to the alphabetically first category. Seven numbers and a name come to the
    driver, and for ``wide`` the list of categories, since they become column names;
    the long form needs none.
    """
    rows = items.dropDuplicates() if dedupe_items else items
    sold = rows.groupBy("product_id").agg(F.count("*").alias("n"))
    no_number, no_text = F.lit(None).cast("double"), F.lit(None).cast("string")
    cells = [
        F.struct(
            F.lit(name).alias("measure"),
            F.col(name).cast("double").alias("number"),
            no_text.alias("category"),
        )
        for name in PRODUCT_MEASURES
    ]
    cells.append(
        F.struct(
            F.lit(CATEGORY).alias("measure"),
            no_number.alias("number"),
            F.col(CATEGORY).alias("category"),
        )
    )
    values = (
        sold.join(products, "product_id")
        .select("n", F.inline(F.array(*cells)))
        .groupBy("measure", "number", "category")
        .agg(F.sum("n").alias("n"))
        .persist()
    )
    try:
        number, n = F.col("number"), F.col("n")
        mean = F.avg(number) if distinct_means else F.sum(number * n) / F.sum(n)
        fitted = (
            values.where(number.isNotNull()).groupBy("measure")
            .agg(mean.alias("mean"), F.bool_and(number == F.floor(number)).alias("whole")).collect()
        )
        named = values.where(F.col("category").isNotNull())
        top = named.orderBy(F.desc("n"), "category").select("category").first()
        names = [row["category"] for row in named.select("category").distinct().collect()] if wide else []
    finally:
        values.unpersist()
    return ItemStats(
        means={row["measure"]: row["mean"] for row in fitted},
        mode=top["category"] if top else None,
        categories=tuple(sorted(names)),
        whole=tuple(sorted(row["measure"] for row in fitted if row["whole"])),
    )


def prepare_items(items: DataFrame, products: DataFrame, stats: ItemStats, dedupe_items: bool = True) -> DataFrame:
    """Distinct, fully imputed items with their product columns.

    Distinct items joined to distinct filled products are distinct already, so the
    joined table, the widest of all, needs no de-duplication shuffle of its own.
    Without ``dedupe_items`` the items are taken as distinct, as those of ``shared_items`` are.
    """
    catalogue = stats.fill(products).dropDuplicates()
    return stats.fill(with_products(items.dropDuplicates() if dedupe_items else items, catalogue))


_SUMMED = ("price", "shipping_cost", *AVERAGED_MEASURES)


def _terms(items_products: DataFrame) -> DataFrame:
    """Key, category and exact terms of every item. Without price or shipping cost there is no amount."""
    parts = [money.cents("price"), money.cents("shipping_cost")]
    amount = parts[0] + parts[1]
    return items_products.select(
        "order_id",
        F.col(CATEGORY).alias("category"),
        F.expr("int(order_item_id IS NOT NULL)").alias("total_items"),
        *[money.cents(name).alias(f"cents_{name}") for name in _SUMMED],
        *[money.rest(name).alias(f"rest_{name}") for name in _SUMMED],
        *[F.expr(f"int({name} IS NOT NULL)").alias(f"n_{name}") for name in _SUMMED],
        amount.alias("amount_cents"),
        F.when(amount.isNull(), money.units("price") + money.units("shipping_cost")).alias("amount_rest"),
    )


def _order_sums(rows: DataFrame) -> DataFrame:
    """Counts and sums of the terms of an order's items."""
    return rows.groupBy("order_id").agg(*_sums(rows))


def _sums(rows: DataFrame) -> list[Column]:
    """The sum of every term but amounts, which are summed by category."""
    names = [name for name in rows.columns if name not in ("order_id", "category", "amount_cents", "amount_rest")]
    return [(money.sum_rest(name) if name.startswith("rest_") else F.sum(name)).alias(name) for name in names]


def _costs() -> list[Column]:
    means = {
        f"average_{name}": money.sum_mean_to_cents(f"cents_{name}", f"rest_{name}", f"n_{name}") for name in _SUMMED
    }
    return [
        money.sum_to_cents("cents_price", "rest_price").alias("total_price"),
        money.sum_to_cents("cents_shipping_cost", "rest_shipping_cost").alias("total_shipping_cost"),
        means.pop("average_price").alias("average_price"),
        means.pop("average_shipping_cost").alias("average_shipping_cost"),
        *[value.alias(name) for name, value in means.items()],
    ]


#: Category columns that are summed in one pass with everything else. With more the generated
#: method gets too long to be compiled, and they take a pivot of their own.
MOST_SLOTS = 6


def _one_pass(rows: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Sums, means and category columns by one aggregate: items are read and gathered once."""
    own = {f"slot_{i}": F.col("category") == F.lit(name) for i, name in enumerate(categories)}
    dealt = rows.withColumns({f"{slot}_rest": F.when(here, F.col("amount_rest")) for slot, here in own.items()})
    slots = [F.sum(F.when(here, F.col("amount_cents"))).alias(f"{slot}_cents") for slot, here in own.items()]
    slots += [money.sum_rest(f"{slot}_rest").alias(f"{slot}_rest") for slot in own]
    names = unique_names([AMOUNT_PREFIX + name for name in categories])
    amounts = [
        F.coalesce(money.sum_unrounded(f"{slot}_cents", f"{slot}_rest"), F.lit(0.0)).alias(name) for slot, name in zip(own, names)
    ]
    return dealt.groupBy("order_id").agg(*_sums(rows), *slots).select("order_id", "total_items", *_costs(), *amounts)


def _wide(rows: DataFrame, categories: Sequence[str]) -> DataFrame:
    """(order_id, amount per category): a pivot with a list of values, one slot for each.

    Amounts are summed per order and category first, so what is put into slots is at most
    one row for each category that an order has.
    """
    names = unique_names([AMOUNT_PREFIX + name for name in categories])
    if not categories:
        return rows.select("order_id").distinct()
    # One double for each order and category; its maximum there is itself.
    slots = _amounts(rows).groupBy("order_id").pivot("category", list(categories)).agg(F.max("amount"))
    # By place: category names may differ in case alone, or clash with the key.
    slots = slots.toDF("order_id", *[f"slot_{i}" for i in range(len(categories))])
    return slots.select("order_id", *[F.coalesce(f"slot_{i}", F.lit(0.0)).alias(name) for i, name in enumerate(names)])


def _amounts(rows: DataFrame) -> DataFrame:
    """(order_id, category, amount): the exact sum as a double; no amount counts as 0."""
    summed = rows.groupBy("order_id", "category").agg(F.sum("amount_cents").alias("cents"), money.sum_rest("amount_rest").alias("rest"))
    return summed.select("order_id", "category", F.coalesce(money.sum_unrounded("cents", "rest"), F.lit(0.0)).alias("amount"))


def unique_names(names: Sequence[str]) -> list[str]:
    """Column names that differ even without case: a repeated one gets a number."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        while (times := seen.get(name.lower(), 0)):
            seen[name.lower()] = times + 1
            name = f"{name}_{times + 1}"
        seen[name.lower()] = 1
        out.append(name)
    return out


def items_per_order(items_products: DataFrame, categories: Sequence[str], one_pass: bool = False) -> DataFrame:
    """Item count, totals, means and the amount per category, one row per order.

    Sums and category columns are two aggregates by order; on a table bucketed by order
    neither needs an exchange, nor does joining them. With ``one_pass`` and few categories
    they are one aggregate. Items without an order have no row.
    """
    rows = _terms(items_products).where("order_id IS NOT NULL")
    if one_pass and len(categories) <= MOST_SLOTS:
        return _with_total(_one_pass(rows, categories))
    sums = _order_sums(rows).select("order_id", "total_items", *_costs())
    wide = _wide(rows, categories).withColumnRenamed("order_id", "wide_id")
    order = [*sums.columns, *[c for c in wide.columns if c != "wide_id"]]
    # Left, so that Spark leaves the pivot out where no category column is used.
    met = sums.join(wide, F.col("order_id") == F.col("wide_id"), "left").select(*[F.col(quoted(c)) for c in order])
    return _with_total(met)


def category_amounts(items_products: DataFrame, categories: Sequence[str]) -> DataFrame:
    """Only the amount per category, one row per order and a column per category."""
    return _wide(_terms(items_products), categories)


def category_amounts_long(items_products: DataFrame) -> DataFrame:
    """(order_id, category, amount), for any number of categories; no amount counts as 0."""
    return _amounts(_terms(items_products))


def order_costs(items_products: DataFrame) -> DataFrame:
    """Only totals and means, one row per order."""
    return _with_total(_order_sums(_terms(items_products)).select("order_id", *_costs()))


def items_counted(items_products: DataFrame) -> DataFrame:
    """Only the item count, one row per order."""
    return _order_sums(_terms(items_products)).select("order_id", "total_items")


def _with_total(rows: DataFrame) -> DataFrame:
    return rows.withColumn("total_amount", F.expr("total_price + total_shipping_cost"))
