"""Base tables: prepared parts joined to one row per review or per order."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from orderloom.operators import clean
from orderloom.operators.items import ItemStats, fit_item_stats, items_per_order, prepare_items, shared_items
from orderloom.operators.orders import HOLDOUT_WINDOW, TRAINING_WINDOW, prepare_orders
from orderloom.operators.payments import payments_per_order
from orderloom.operators.profile import most_frequent
from orderloom.operators.reviews import TIES, newest_times, prepare_reviews_with_ties, timed_reviews
from orderloom.session import tasks_for
from orderloom.sources.tables import OrderTables


#: Reviews of one order that may meet in one task; more are dealt out by a salt.
ROWS_PER_TASK = 1_000_000


@dataclass(frozen=True)
class OrderParts:
    """Prepared tables on their way into a base table.

    Payments and items have one row per order_id by construction, orders by the
    meaning of the table. Reviews repeat an order_id where answer times tie, and carry
    the number of ties; ``tied`` lists the orders with more than ``rows_per_task`` of them
    and is None where no order has so many reviews.
    """

    orders: DataFrame
    payments: DataFrame
    items: DataFrame
    reviews: DataFrame | None = None
    tied: DataFrame | None = None
    rows_per_task: int = ROWS_PER_TASK


def with_shared_items(tables: OrderTables) -> OrderTables:
    """The tables with items as one bucketed table, from which statistics and parts are made.

    Items and payments are gathered by equally many tasks, so that they meet in place.
    """
    tasks = max(tasks_for(tables.order_items), tasks_for(tables.order_payments))
    return replace(tables, order_items=shared_items(tables.order_items, tasks=tasks), tasks=tasks)


def fit_shared_stats(tables: OrderTables, wide: bool = True) -> ItemStats:
    """``fit_item_stats`` over the tables of ``with_shared_items``, whose items are distinct already."""
    return fit_item_stats(tables.order_items, tables.products, dedupe_items=tables.tasks is None, wide=wide)


def prepare_parts(
    tables: OrderTables,
    stats: ItemStats,
    window: tuple[str, str],
    convention: str = "shifted",
    unique_reviews: bool = False,
    rows_per_task: int = ROWS_PER_TASK,
) -> OrderParts:
    shared = tables.tasks is not None
    items = prepare_items(tables.order_items, tables.products, stats, dedupe_items=not shared)
    reviews = tied = None
    if tables.order_reviews is not None and (not shared or most_frequent(tables.order_reviews, "order_id")[1] > rows_per_task):
        tied = newest_times(timed_reviews(tables.order_reviews)).where(F.col(TIES) > rows_per_task).select("order_id", TIES)
    if tables.order_reviews is not None:
        reviews = prepare_reviews_with_ties(tables.order_reviews, unique_reviews, convention)
    return OrderParts(
        orders=prepare_orders(tables.orders, window, convention),
        payments=payments_per_order(tables.order_payments, tables.tasks),
        items=items_per_order(items, stats.categories, one_pass=shared),
        reviews=reviews,
        tied=tied,
        rows_per_task=rows_per_task,
    )


def _to_reviews(reviews: DataFrame, sides: DataFrame, tied: DataFrame | None, how: str, rows_per_task: int) -> DataFrame:
    """Reviews joined to one row per order, those of an order with many ties by salt.

    Every review knows how many tie with it, so it knows how many ways its order is
    dealt out, and a row of the sides is repeated as often for those orders alone:
    one plan, whatever the data, with nothing collected and nothing broadcast. Without a
    list of tied orders nothing is dealt out, and the sides stay where they were gathered.
    """
    if tied is None:
        return reviews.drop(TIES).join(sides, "order_id", how)
    ways = lambda ties: F.ceil(F.coalesce(ties, F.lit(1)) / rows_per_task)
    salted = reviews.withColumn("salt", F.pmod(F.xxhash64("review_id"), ways(F.col(TIES)))).drop(TIES)
    repeated = sides.join(tied, "order_id", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("bigint"), ways(F.col(TIES)) - 1))
    ).drop(TIES)
    return salted.join(repeated, ["order_id", "salt"], how).drop("salt")


def join_parts(parts: OrderParts) -> DataFrame:
    """Reviews (or, without reviews, orders) with everything known about their order.

    A review without order, payment or items keeps its row.
    """
    if parts.reviews is None:
        return parts.orders.join(parts.payments, "order_id", "left").join(parts.items, "order_id", "left")
    sides = parts.orders.join(parts.payments, "order_id", "full").join(parts.items, "order_id", "full")
    return _to_reviews(parts.reviews, sides, parts.tied, "left", parts.rows_per_task)


def complete_rows(parts: OrderParts) -> DataFrame:
    """The rows of ``join_parts`` without any null.

    A row that found no order, payment or items would be dropped, so these are
    inner joins, and the parts lose their incomplete rows before they are shuffled.
    """
    orders, payments, items = map(clean.all_present, (parts.orders, parts.payments, parts.items))
    sides = orders.join(payments, "order_id").join(items, "order_id")
    if parts.reviews is None:
        return sides
    return _to_reviews(clean.all_present(parts.reviews), sides, parts.tied, "inner", parts.rows_per_task)


def build_basetable(parts: OrderParts, drop_subset: Iterable[str] | None = None) -> DataFrame:
    """Model-ready rows.

    By default rows with any null go. A day count is null only where one of its
    times is, so such rows go as well and the fill value for missing days is never
    seen. With ``drop_subset`` only nulls in those columns remove a row, and
    missing day counts keep the fill value.
    """
    if drop_subset is None:
        return complete_rows(parts)
    return clean.drop_incomplete(clean.fill_missing_days(join_parts(parts)), drop_subset)


def training_basetable(
    tables: OrderTables,
    stats: ItemStats | None = None,
    window: tuple[str, str] = TRAINING_WINDOW,
    drop_subset: Iterable[str] | None = None,
    convention: str = "shifted",
    unique_reviews: bool = False,
) -> DataFrame:
    """Base table of reviewed orders; statistics are fitted on the tables if not given."""
    if stats is None:
        tables = with_shared_items(tables)
        stats = fit_shared_stats(tables)
    parts = prepare_parts(tables, stats, window, convention, unique_reviews)
    return build_basetable(parts, drop_subset)


def holdout_basetable(
    tables: OrderTables,
    stats: ItemStats,
    window: tuple[str, str] = HOLDOUT_WINDOW,
    drop_subset: Iterable[str] | None = None,
    convention: str = "shifted",
) -> DataFrame:
    """Base table of unreviewed orders, prepared with the training statistics."""
    return build_basetable(prepare_parts(with_shared_items(tables), stats, window, convention), drop_subset)


def incomplete_rows_count(joined: DataFrame) -> DataFrame:
    """One row: rows of a joined table, and how many of them ``complete_rows`` drops."""
    has_null = reduce(or_, [F.col(clean.quoted(name)).isNull() for name in joined.columns])
    return joined.agg(
        F.count("*").alias("row_count"), F.count_if(has_null).alias("incomplete_rows")
    )
