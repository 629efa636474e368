"""Orders: purchase window, key filter, time casts and delivery features."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderloom.functions import calendar
from orderloom.operators import clean

TIMES = {
    "order_purchase_timestamp": "order_purchase_time",
    "order_approved_at": "order_approved_at_time",
    "order_delivered_carrier_date": "order_delivered_carrier_date_time",
    "order_delivered_customer_date": "order_delivered_customer_date_time",
    "order_estimated_delivery_date": "order_estimated_delivery_date_time",
}
# Purchase windows of the original files, bounds included.
TRAINING_WINDOW = ("2020-07-01 00:00:00", "2022-06-30 23:59:59")
HOLDOUT_WINDOW = ("2022-07-01 00:00:00", "2022-09-30 23:59:59")


def cast_order_times(raw: DataFrame) -> DataFrame:
    return clean.cast_times(raw, TIMES)


def add_delivery_days(orders: DataFrame) -> DataFrame:
    """Days early, days to approval and days to delivery, as doubles."""
    bought, approved = F.col("order_purchase_time"), F.col("order_approved_at_time")
    delivered = F.col("order_delivered_customer_date_time")
    promised = F.col("order_estimated_delivery_date_time")
    days = {
        "estimated_delivery_days": calendar.days_between(promised, delivered),
        "order_to_approval_days": calendar.days_between(approved, bought),
        "actual_delivered_days": calendar.days_between(delivered, bought),
    }
    return orders.withColumns({name: value.cast("double") for name, value in days.items()})


def add_order_features(orders: DataFrame, convention: str = "shifted") -> DataFrame:
    bought = F.col("order_purchase_time")
    delivered = F.col("order_delivered_customer_date_time")
    return add_delivery_days(orders).withColumns({
        "DeliveryTimeStatus": calendar.delivery_status(F.col("estimated_delivery_days")),
        "order_time_of_day": calendar.time_of_day(bought),
        "order_purchase_weekend_or_weekday": calendar.weekday_flag(bought, convention),
        "delivery_time_of_day": calendar.time_of_day(delivered),
        "order_delivered_weekend_or_weekday": calendar.weekday_flag(delivered, convention),
    })


def prepare_orders(
    raw: DataFrame,
    window: tuple[str, str] = TRAINING_WINDOW,
    convention: str = "shifted",
) -> DataFrame:
    """Raw orders of one purchase window with features; a single narrow stage.

    Keys that stand for "missing" go before any shuffle, so that they cannot pile
    up in one partition of a later join.
    """
    timed = cast_order_times(clean.drop_na_keys(raw))
    return add_order_features(clean.in_time_range(timed, "order_purchase_time", *window), convention)
