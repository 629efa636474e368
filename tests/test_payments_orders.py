from __future__ import annotations

from conftest import rows

from orderloom.operators import orders, payments
from orderloom.sources import schemas

PAYMENTS = [
    ("a", 1, "card", 3, 10.0),
    ("a", 1, "card", 3, 10.0),  # whole-row copy
    ("a", 2, "voucher", 1, 5.01),
    ("b", 2, "voucher", 2, 7.0),
    ("c", 1, "voucher", 1, 1.0),
    ("c", 1, "boleto", 1, 2.0),
]


def test_payment_facts(spark):
    df = spark.createDataFrame(PAYMENTS, schemas.ORDER_PAYMENTS)
    out = {r.order_id: r for r in payments.payment_facts(df).collect()}
    a, b, c = out["a"], out["b"], out["c"]
    assert (a.payment_type, a.min_payment_sequential, a.max_payment_sequential) == ("card", 1, 2)
    assert (a.min_payment_installments, a.max_payment_installments) == (1, 3)
    assert (a.total_payment_value, a.average_payment_value) == (15.01, 7.51)  # 7.505 rounds up
    assert (a.min_payment_value, a.max_payment_value) == (5.01, 10.0)
    assert b.payment_type == "voucher"
    assert c.payment_type == "boleto"  # equal sequence: first by name
    assert payments.payments_per_order(df).columns == [
        "order_id", "payment_type", "max_payment_sequential", "max_payment_installments", "total_payment_value",
    ]


def test_both_ways_to_gather_payments_agree(spark):
    df = spark.createDataFrame([*PAYMENTS, (None, 1, "card", 1, 1.0), ("NA", 1, "card", 1, 2.0)], schemas.ORDER_PAYMENTS)
    one, two = payments.payment_facts(df), payments.payment_facts(df, spread=True)
    assert rows(one) == rows(two) and {r[0] for r in rows(one, "order_id")} == {"a", "b", "c"}


def test_agreement(spark):
    df = spark.createDataFrame(PAYMENTS, schemas.ORDER_PAYMENTS)
    assert rows(payments.payment_agreement(df)) == [
        ("installments_min_is_max", 2), ("sequential_min_is_max", 2),
        ("total_is_average", 1), ("total_is_max", 1), ("total_is_min", 1),
    ]


def test_prepared_orders(spark):
    def order(key, bought, delivered, promised="2021-01-20 00:00:00"):
        return (key, "delivered", bought, "2021-01-11 08:00:00", "2021-01-12 00:00:00", delivered, promised)

    raw = spark.createDataFrame([
        order("early", "2021-01-10 23:00:00", "2021-01-19 23:59:59"),
        order("same day", "2021-01-10 06:00:00", "2021-01-20 18:00:00"),
        order("late", "2021-01-10 18:30:00", "2021-01-21 00:00:00"),
        order("not delivered", "2021-01-10 12:00:00", "NA"),
        order("NA", "2021-01-10 12:00:00", "NA"),
        order("old", "2020-06-30 23:59:59", "NA"),
        order("no purchase", "NA", "NA"),
    ], schemas.ORDERS)
    out = {r.order_id: r for r in orders.prepare_orders(raw).collect()}
    assert set(out) == {"early", "same day", "late", "not delivered"}
    assert {k: r.DeliveryTimeStatus for k, r in out.items()} == {
        "early": "early", "same day": "timely", "late": "delayed", "not delivered": "timely",
    }
    early, missing = out["early"], out["not delivered"]
    assert (early.estimated_delivery_days, early.order_to_approval_days, early.actual_delivered_days) == (1.0, 1.0, 9.0)
    assert (early.order_time_of_day, early.delivery_time_of_day) == ("night", "night")
    # a Sunday purchase counts as a weekday, see calendar.CONVENTIONS
    assert early.order_purchase_weekend_or_weekday == "weekday"
    assert missing.estimated_delivery_days is None and missing.actual_delivered_days is None
    assert (missing.delivery_time_of_day, missing.order_delivered_weekend_or_weekday) == ("night", "weekend")


def test_order_schema(spark):
    out = orders.prepare_orders(spark.createDataFrame([], schemas.ORDERS))
    assert dict(out.dtypes) == {
        "order_id": "string", "order_status": "string",
        **{name: "timestamp_ntz" for name in orders.TIMES.values()},
        **{name: "double" for name in ("estimated_delivery_days", "order_to_approval_days", "actual_delivered_days")},
        "DeliveryTimeStatus": "string", "order_time_of_day": "string",
        "order_purchase_weekend_or_weekday": "string", "delivery_time_of_day": "string",
        "order_delivered_weekend_or_weekday": "string",
    }
