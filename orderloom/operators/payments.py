"""Payments: de-duplication and one row per order."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions import money
from orderloom.operators.clean import drop_na_keys
from orderloom.operators.profile import count_checks, has_hot_key
from orderloom.session import tasks_for


def payment_facts(payments: DataFrame, spread: bool | None = None, tasks: int | None = None) -> DataFrame:
    """Everything known about an order's payments, from one exchange.

    Rows without an order go first. The others are exchanged by order once; copies are
    dropped and facts gathered where they are then, by as many tasks as the table's size
    asks for unless ``tasks`` does, so that none holds more of a larger table. ``spread`` is for tables in which one
    order holds a large share of all payments: copies are then dropped by whole row, and
    combined facts exchanged once more. Unless it is given, large tables are looked
    through for such an order.

    The payment type is that of the lowest sequence number, and of equals the
    alphabetically first. Callers select what they need; Spark drops the rest of
    the aggregates.
    """
    first = F.struct("payment_sequential", "payment_type")
    known = drop_na_keys(payments)
    if spread is None:
        spread = has_hot_key(known, "order_id")
    facts = (
        (known if spread else known.repartition(tasks or tasks_for(known), "order_id")).dropDuplicates()
        .withColumns({"cents": money.cents("payment_value"), "rest": money.rest("payment_value")})
        .groupBy("order_id")
        .agg(
            F.min_by("payment_type", first).alias("payment_type"),
            F.min("payment_sequential").alias("min_payment_sequential"),
            F.max("payment_sequential").alias("max_payment_sequential"),
            F.min("payment_installments").alias("min_payment_installments"),
            F.max("payment_installments").alias("max_payment_installments"),
            F.min("payment_value").alias("min_payment_value"),
            F.max("payment_value").alias("max_payment_value"),
            F.sum("cents").alias("cents"),
            money.sum_rest("rest").alias("rest"),
            (F.count("cents") + F.count("rest")).alias("n"),
        )
    )
    return facts.withColumns({
        "total_payment_value": money.sum_to_cents("cents", "rest"),
        "average_payment_value": money.sum_mean_to_cents("cents", "rest", "n"),
    }).drop("cents", "rest", "n")


def payments_per_order(payments: DataFrame, tasks: int | None = None) -> DataFrame:
    """The payment columns of the base table."""
    return payment_facts(payments, tasks=tasks).select(
        "order_id",
        "payment_type",
        "max_payment_sequential",
        "max_payment_installments",
        "total_payment_value",
    )


def payment_agreement(payments: DataFrame) -> DataFrame:
    """For how many orders pairs of payment facts agree; all pairs in one pass."""
    total = F.col("total_payment_value")
    return count_checks(payment_facts(payments), {
        "sequential_min_is_max": F.col("min_payment_sequential") == F.col("max_payment_sequential"),
        "installments_min_is_max": F.col("min_payment_installments") == F.col("max_payment_installments"),
        "total_is_average": total == F.col("average_payment_value"),
        "total_is_min": total == F.col("min_payment_value"),
        "total_is_max": total == F.col("max_payment_value"),
    })
