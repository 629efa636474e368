"""Order-shaped inputs derived by column arithmetic from the given star schema.

The given tables have no nulls and midnight-only dates, so missing values, hours
and duplicate rows are planted here by arithmetic on keys. Every view keeps all
rows of its source table and is a narrow, single-scan projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderloom.operators import clean
from orderloom.sources.tables import OrderTables

#: Purchase windows on the stand-in time line (inclusive bounds).
TRAINING = ("1995-01-01 00:00:00", "2000-06-30 23:59:59")
HOLDOUT = ("2000-07-01 00:00:00", "2001-12-31 23:59:59")


#: The columns used, so that reading needs no schema job.
_COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string",
    "part": "p_partkey bigint, p_name string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[table]).parquet(f"{folder}/{table}.parquet")


def _later(ts: Column, days: Column | int = 0, hours: Column | int = 0) -> Column:
    as_int = lambda n: (n if isinstance(n, Column) else F.lit(n)).cast("int")
    return ts + F.make_dt_interval(as_int(days), as_int(hours))


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    """All line items; rows of quantity 1 appear twice, quantity 50 has no shipping cost."""
    quantity = F.col("l_quantity")
    copies = F.array_repeat(F.lit(1), F.when(quantity == 1, 2).otherwise(1))
    return (
        load(spark, folder, "lineitem")
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("order_item_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("price"),
            F.nullif(quantity, F.lit(50.0)).alias("shipping_cost"),
            F.explode(copies).alias("copy"),
        )
        .drop("copy")
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return products_of(load(spark, folder, "part"))


def products_of(part: DataFrame, category: Column | None = None) -> DataFrame:
    """Products from parts; ``category`` replaces their category, which parts of some sizes lack."""
    key, size = F.col("p_partkey"), F.col("p_size")
    described = size % 10 != 0
    named = F.when(described, F.col("p_type")) if category is None else category
    return part.select(
        key.alias("product_id"),
        F.when(described, F.length("p_name")).alias("product_name_lenght"),
        F.when(described, size * 20).alias("product_description_lenght"),
        F.when(described, (1 + key % 5).cast("int")).alias("product_photos_qty"),
        F.when(size != 50, size * 50).alias("product_weight_g"),
        (10 + key % 30).cast("int").alias("product_length_cm"),
        (5 + key % 11).cast("int").alias("product_height_cm"),
        (8 + key % 17).cast("int").alias("product_width_cm"),
        named.alias("product_category_name"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key, customer, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    delivered = _later(day, 3 + customer % 20, key * 7 % 24)
    return load(spark, folder, "orders").select(
        key.alias("order_id"),
        F.col("o_orderstatus").alias("order_status"),
        _later(day, hours=key % 24).alias("order_purchase_timestamp"),
        F.when(customer % 50 != 0, _later(day, customer % 3, 20)).alias("order_approved_at"),
        _later(day, 4).alias("order_delivered_carrier_date"),
        F.when(key % 37 != 0, delivered).alias("order_delivered_customer_date"),
        _later(day, 12).alias("order_estimated_delivery_date"),
    )


def orders_as_text(spark: SparkSession, folder: str) -> DataFrame:
    """The orders as an export would hold them: all text, ``NA`` for what is missing."""
    typed = orders(spark, folder)
    key = F.when(F.col("order_id") % 101 == 0, "NA").otherwise(F.col("order_id").cast("string"))
    times = [name for name in typed.columns if name not in ("order_id", "order_status")]
    return typed.select(
        key.alias("order_id"),
        "order_status",
        *[F.coalesce(F.col(name).cast("string"), F.lit("NA")).alias(name) for name in times],
    )


def order_payments(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.col("l_returnflag").alias("payment_type"),
        (1 + F.col("l_quantity").cast("int") % 10).alias("payment_installments"),
        F.col("l_extendedprice").alias("payment_value"),
    )


def order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    event = F.col("event_id")
    answered = F.col("event_type") != "error"
    return load(spark, folder, "events").select(
        event.alias("review_id"),
        F.when((event % 5 == 0) & (event > 0), event - 1).otherwise(event).alias("order_id"),
        (1 + F.floor("value") % 5).cast("int").alias("review_score"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("review_creation_date"),
        F.when(answered, _later(F.col("ts"), F.col("user_id") % 4)).alias("review_answer_timestamp"),
    )


def training_tables(spark: SparkSession, folder: str) -> OrderTables:
    return OrderTables(
        orders=orders(spark, folder),
        order_items=order_items(spark, folder),
        products=products(spark, folder),
        order_payments=order_payments(spark, folder),
        order_reviews=order_reviews(spark, folder),
    )


def holdout_tables(spark: SparkSession, folder: str) -> OrderTables:
    """The holdout files: orders bought after the training window, with their rows."""
    later_orders = clean.in_time_range(orders(spark, folder), "order_purchase_timestamp", *HOLDOUT)
    keys = later_orders.select("order_id")
    return OrderTables(
        orders=later_orders,
        order_items=order_items(spark, folder).join(keys, "order_id", "left_semi"),
        products=products(spark, folder),
        order_payments=order_payments(spark, folder).join(keys, "order_id", "left_semi"),
    )
