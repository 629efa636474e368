"""Explicit schemas of the five input tables.

Reading with a schema skips the extra pass that inference costs and keeps types
from depending on the data. CSV columns are found by name; product measures are
read as doubles there, since an export may hold fractions. Times are text here because exports mix in the token
``NA``; the order and review operators turn them into timestamps.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and tokens of the input files, spelt as in the data.
NA_TOKEN = "NA"

ORDER_REVIEWS = T.StructType([
    T.StructField("review_id", T.StringType()),
    T.StructField("order_id", T.StringType()),
    T.StructField("review_score", T.IntegerType()),
    T.StructField("review_creation_date", T.TimestampNTZType()),
    T.StructField("review_answer_timestamp", T.StringType()),
])
ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_item_id", T.IntegerType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("shipping_cost", T.DoubleType()),
])
PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("product_name_lenght", T.IntegerType()),
    T.StructField("product_description_lenght", T.IntegerType()),
    T.StructField("product_photos_qty", T.IntegerType()),
    T.StructField("product_weight_g", T.IntegerType()),
    T.StructField("product_length_cm", T.IntegerType()),
    T.StructField("product_height_cm", T.IntegerType()),
    T.StructField("product_width_cm", T.IntegerType()),
    T.StructField("product_category_name", T.StringType()),
])
ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("order_status", T.StringType()),
    T.StructField("order_purchase_timestamp", T.StringType()),
    T.StructField("order_approved_at", T.StringType()),
    T.StructField("order_delivered_carrier_date", T.StringType()),
    T.StructField("order_delivered_customer_date", T.StringType()),
    T.StructField("order_estimated_delivery_date", T.StringType()),
])
ORDER_PAYMENTS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("payment_sequential", T.IntegerType()),
    T.StructField("payment_type", T.StringType()),
    T.StructField("payment_installments", T.IntegerType()),
    T.StructField("payment_value", T.DoubleType()),
])

BY_TABLE = {
    "order_reviews": ORDER_REVIEWS,
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_payments": ORDER_PAYMENTS,
}
#: Tables whose text columns double the quote sign inside quoted fields.
DOUBLED_QUOTES = frozenset({"products", "orders"})

PRODUCT_MEASURES = (
    "product_name_lenght",
    "product_description_lenght",
    "product_photos_qty",
    "product_weight_g",
    "product_length_cm",
    "product_height_cm",
    "product_width_cm",
)
CATEGORY = "product_category_name"
