"""The registered queries in SQL, for comparison.

Written the long way round on purpose (windows, self joins, DISTINCT over joined
tables, one aggregate per table and then joins), so that agreement with the
DataFrame operators says something.
"""

from __future__ import annotations

CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
MEASURES = (
    "product_name_lenght", "product_description_lenght", "product_photos_qty", "product_weight_g",
    "product_length_cm", "product_height_cm", "product_width_cm",
)
TIMES = (
    "order_purchase_time", "order_approved_at_time", "order_delivered_carrier_date_time",
    "order_delivered_customer_date_time", "order_estimated_delivery_date_time",
)
DAYS = ("estimated_delivery_days", "order_to_approval_days", "actual_delivered_days")

# --- stand-in inputs ---------------------------------------------------------

ORDER_ITEMS = """
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
         l_extendedprice AS price, nullif(l_quantity, 50) AS shipping_cost
  FROM lineitem
  UNION ALL
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity
  FROM lineitem WHERE l_quantity = 1"""

PRODUCTS = """
  SELECT p_partkey AS product_id,
         CASE WHEN p_size % 10 <> 0 THEN CAST(length(p_name) AS INTEGER) END AS product_name_lenght,
         CASE WHEN p_size % 10 <> 0 THEN p_size * 20 END AS product_description_lenght,
         CASE WHEN p_size % 10 <> 0 THEN CAST(1 + p_partkey % 5 AS INTEGER) END AS product_photos_qty,
         CASE WHEN p_size <> 50 THEN p_size * 50 END AS product_weight_g,
         CAST(10 + p_partkey % 30 AS INTEGER) AS product_length_cm,
         CAST(5 + p_partkey % 11 AS INTEGER) AS product_height_cm,
         CAST(8 + p_partkey % 17 AS INTEGER) AS product_width_cm,
         CASE WHEN p_size % 10 <> 0 THEN p_type END AS product_category_name
  FROM part"""

ORDERS_IN = """
  SELECT o_orderkey AS order_id, o_orderstatus AS order_status,
         o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS order_purchase_time,
         CASE WHEN o_custkey % 50 <> 0
              THEN o_orderdate + to_days(CAST(o_custkey % 3 AS INTEGER)) + to_hours(20)
         END AS order_approved_at_time,
         o_orderdate + to_days(4) AS order_delivered_carrier_date_time,
         CASE WHEN o_orderkey % 37 <> 0
              THEN o_orderdate + to_days(CAST(3 + o_custkey % 20 AS INTEGER))
                   + to_hours(CAST(o_orderkey * 7 % 24 AS INTEGER))
         END AS order_delivered_customer_date_time,
         o_orderdate + to_days(12) AS order_estimated_delivery_date_time
  FROM orders"""

ORDERS_TEXT = """
  SELECT CASE WHEN order_id % 101 = 0 THEN 'NA' ELSE CAST(order_id AS VARCHAR) END AS order_id,
         * EXCLUDE (order_id)
  FROM orders_in"""

ORDER_PAYMENTS = """
  SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
         CAST(1 + CAST(l_quantity AS INTEGER) % 10 AS INTEGER) AS payment_installments,
         l_extendedprice AS payment_value
  FROM lineitem"""

REVIEWS_RAW = """
  SELECT event_id AS review_id,
         CASE WHEN event_id % 5 = 0 AND event_id > 0 THEN event_id - 1 ELSE event_id END AS order_id,
         CAST(1 + CAST(floor(value) AS BIGINT) % 5 AS INTEGER) AS review_score,
         CAST(date_trunc('day', ts) AS TIMESTAMP) AS review_creation_date,
         CASE WHEN event_type <> 'error' THEN ts + to_days(CAST(user_id % 4 AS INTEGER)) END
           AS review_answer_time
  FROM events"""

ORDER_REVIEWS = """
  SELECT review_id, order_id, review_score, review_creation_date,
         CASE WHEN review_answer_time IS NULL
              THEN CAST(CAST(review_creation_date AS DATE) + 1 AS TIMESTAMP)
              ELSE review_answer_time END AS review_answer_time
  FROM reviews_raw"""

# --- small expressions -------------------------------------------------------


def cents(value: str) -> str:
    return f"CAST(round(({value}) * 100) AS BIGINT)"


def total(value: str) -> str:
    return f"CAST(sum({cents(value)}) AS BIGINT) / 100.0::DOUBLE"


def mean(value: str) -> str:
    s, n = f"CAST(sum({cents(value)}) AS BIGINT)", f"count({value})"
    return f"((2 * {s} + {n}) // (2 * {n})) / 100.0::DOUBLE"


def time_of_day(ts: str) -> str:
    return (
        f"CASE WHEN hour({ts}) IN (6,7,8,9,10,11) THEN 'morning' "
        f"WHEN hour({ts}) IN (12,13,14,15,16,17) THEN 'afternoon' "
        f"WHEN hour({ts}) IN (18,19) THEN 'evening' ELSE 'night' END"
    )


def weekday_flag(ts: str) -> str:
    """DuckDB numbers Sunday 0: Sunday to Thursday count as weekdays."""
    return f"CASE WHEN dayofweek({ts}) < 5 THEN 'weekday' ELSE 'weekend' END"


def day_name(ts: str) -> str:
    return (
        f"CASE dayofweek({ts}) WHEN 0 THEN 'Monday' WHEN 1 THEN 'Tuesday' WHEN 2 THEN 'Wednesday' "
        "WHEN 3 THEN 'Thursday' WHEN 4 THEN 'Friday' WHEN 5 THEN 'Saturday' ELSE 'Sunday' END"
    )


def month_name(ts: str) -> str:
    return f"coalesce(monthname({ts}), 'December')"


def days(end: str, start: str) -> str:
    return f"date_diff('day', {start}, {end})"


# --- prepared tables ---------------------------------------------------------


def delivery_days(source: str) -> str:
    est = days("order_estimated_delivery_date_time", "order_delivered_customer_date_time")
    app = days("order_approved_at_time", "order_purchase_time")
    act = days("order_delivered_customer_date_time", "order_purchase_time")
    return f"""
  SELECT *, CAST({est} AS DOUBLE) AS estimated_delivery_days,
         CAST({app} AS DOUBLE) AS order_to_approval_days,
         CAST({act} AS DOUBLE) AS actual_delivered_days
  FROM {source}"""


TRAINING = "order_purchase_time >= TIMESTAMP '1995-01-01 00:00:00' AND order_purchase_time <= TIMESTAMP '2000-06-30 23:59:59'"
HOLDOUT = "order_purchase_time >= TIMESTAMP '2000-07-01 00:00:00' AND order_purchase_time <= TIMESTAMP '2001-12-31 23:59:59'"


def orders_final(source: str, window: str) -> str:
    return f"""
  SELECT *,
         CASE WHEN estimated_delivery_days > 0 THEN 'early'
              WHEN estimated_delivery_days < 0 THEN 'delayed' ELSE 'timely' END AS "DeliveryTimeStatus",
         {time_of_day('order_purchase_time')} AS order_time_of_day,
         {weekday_flag('order_purchase_time')} AS order_purchase_weekend_or_weekday,
         {time_of_day('order_delivered_customer_date_time')} AS delivery_time_of_day,
         {weekday_flag('order_delivered_customer_date_time')} AS order_delivered_weekend_or_weekday
  FROM ({delivery_days(source)}) WHERE {window}"""


LATEST = """
  SELECT * EXCLUDE (n, newest) FROM (
    SELECT *, count(review_id) OVER (PARTITION BY order_id) AS n,
           max(review_answer_time) OVER (PARTITION BY order_id) AS newest
    FROM order_reviews)
  WHERE n = 1 OR review_answer_time = newest"""

REVIEWS_FINAL = f"""
  SELECT *, CASE WHEN review_score < 4 THEN 0 ELSE 1 END AS label,
         CAST({days('review_answer_time', 'review_creation_date')} AS INTEGER) AS "DaysTakenForReview",
         {time_of_day('review_answer_time')} AS review_time_of_day,
         {weekday_flag('review_answer_time')} AS review_weekend_or_weekday,
         {day_name('review_answer_time')} AS day_of_the_week,
         {month_name('review_answer_time')} AS "month"
  FROM latest"""


def joined(items: str) -> str:
    return f"""
  SELECT i.order_id, i.order_item_id, i.product_id, i.price, i.shipping_cost,
         {', '.join(f'p.{m}' for m in MEASURES)}, p.product_category_name
  FROM {items} i LEFT JOIN products p ON i.product_id = p.product_id"""


def means(source: str, distinct: bool = True) -> str:
    word = "DISTINCT " if distinct else ""
    return "SELECT " + ", ".join(f"avg({word}{m}) AS m_{m}" for m in MEASURES) + f" FROM {source}"


def mode(source: str) -> str:
    return (
        f"SELECT product_category_name AS mode_category FROM {source} "
        "WHERE product_category_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1"
    )


FILLED_MEASURES = ", ".join(f"coalesce({m}, CAST(trunc(m_{m}) AS INTEGER)) AS {m}" for m in MEASURES)


def imputed(source: str) -> str:
    return f"""
  SELECT DISTINCT order_id, order_item_id, product_id, price, shipping_cost, {FILLED_MEASURES},
         coalesce(product_category_name, mode_category) AS product_category_name
  FROM {source}, means, mode"""


def item_counts(source: str) -> str:
    return f"SELECT order_id, count(order_item_id) AS total_items FROM {source} GROUP BY order_id"


def costs(source: str) -> str:
    averages = ", ".join(f"{mean(m)} AS average_{m}" for m in MEASURES[:4])
    return f"""
  SELECT *, total_price + total_shipping_cost AS total_amount FROM (
    SELECT order_id, {total('price')} AS total_price, {total('shipping_cost')} AS total_shipping_cost,
           {mean('price')} AS average_price, {mean('shipping_cost')} AS average_shipping_cost, {averages}
    FROM {source} GROUP BY order_id)"""


def pivot(source: str) -> str:
    columns = ", ".join(
        f"coalesce(CAST(sum(CASE WHEN product_category_name = '{c}' THEN {cents('price')} + "
        f"{cents('shipping_cost')} END) AS BIGINT) / 100.0::DOUBLE, 0) AS \"total_amount_{c}\""
        for c in CATEGORIES
    )
    return f"SELECT order_id, {columns} FROM {source} GROUP BY order_id"


def items_final(source: str) -> str:
    return f"""
  SELECT * FROM ({item_counts(source)}) LEFT JOIN ({costs(source)}) USING (order_id)
  LEFT JOIN ({pivot(source)}) USING (order_id)"""


def payment_facts(source: str) -> str:
    return f"""
  SELECT * FROM (
    SELECT order_id, min(payment_sequential) AS min_payment_sequential,
           max(payment_sequential) AS max_payment_sequential,
           min(payment_installments) AS min_payment_installments,
           max(payment_installments) AS max_payment_installments
    FROM (SELECT DISTINCT * FROM {source}) GROUP BY order_id)
  JOIN (
    SELECT order_id, {total('payment_value')} AS total_payment_value,
           {mean('payment_value')} AS average_payment_value,
           min(payment_value) AS min_payment_value, max(payment_value) AS max_payment_value
    FROM (SELECT DISTINCT * FROM {source}) GROUP BY order_id) USING (order_id)
  JOIN (
    SELECT order_id, payment_type FROM (
      SELECT order_id, payment_type, row_number() OVER (
        PARTITION BY order_id ORDER BY payment_sequential, payment_type) AS rn FROM {source})
    WHERE rn = 1) USING (order_id)"""


PAYMENTS_FINAL = (
    "SELECT order_id, payment_type, max_payment_sequential, max_payment_installments, "
    "total_payment_value FROM {facts}"
)

FILL_DAYS = ", ".join(f"coalesce({d}, 99999) AS {d}" for d in DAYS)
ALL_PRESENT = "WHERE COLUMNS(*) IS NOT NULL"

#: The common tables of the statements.
TABLES: dict[str, str] = {
    "order_items": ORDER_ITEMS,
    "products": PRODUCTS,
    "orders_in": ORDERS_IN,
    "orders_text": ORDERS_TEXT,
    "order_payments": ORDER_PAYMENTS,
    "reviews_raw": REVIEWS_RAW,
    "order_reviews": ORDER_REVIEWS,
    "latest": LATEST,
    "reviews_final": REVIEWS_FINAL,
    "days": delivery_days("orders_in"),
    "orders_final": orders_final("orders_in", TRAINING),
    "ip_raw": joined("(SELECT DISTINCT * FROM order_items)"),
    "means": means("ip_raw"),
    "mode": mode("ip_raw"),
    "ip": imputed("ip_raw"),
    "items_final": items_final("ip"),
    "facts": payment_facts("order_payments"),
    "payments_final": PAYMENTS_FINAL.format(facts="facts"),
    "chain": """
  SELECT * FROM reviews_final LEFT JOIN orders_final USING (order_id)
  LEFT JOIN payments_final USING (order_id) LEFT JOIN items_final USING (order_id)""",
    "chain_filled": f"SELECT * REPLACE ({FILL_DAYS}) FROM chain",
    "basetable": f"SELECT * FROM chain_filled {ALL_PRESENT}",
    "h_orders_final": orders_final("orders_in", HOLDOUT),
    "h_items": "SELECT * FROM order_items WHERE order_id IN (SELECT order_id FROM h_orders_final)",
    "h_payments": "SELECT * FROM order_payments WHERE order_id IN (SELECT order_id FROM h_orders_final)",
    "h_ip_raw": joined("h_items"),
    "h_ip": imputed("h_ip_raw"),
    "h_items_final": items_final("h_ip"),
    "h_facts": payment_facts("h_payments"),
    "h_payments_final": PAYMENTS_FINAL.format(facts="h_facts"),
    "h_chain": """
  SELECT * FROM h_orders_final LEFT JOIN h_payments_final USING (order_id)
  LEFT JOIN h_items_final USING (order_id)""",
    "h_basetable": f"SELECT * FROM (SELECT * REPLACE ({FILL_DAYS}) FROM h_chain) {ALL_PRESENT}",
}


def with_tables(body: str, **replaced: str) -> str:
    """The statement with the common tables it mentions, directly or through others."""
    tables = {**TABLES, **replaced}

    def mentions(text: str) -> set[str]:
        words = set("".join(c if c.isalnum() or c == "_" else " " for c in text).split())
        return words & set(tables)

    used: list[str] = []
    done: set[str] = set()

    def define(text: str) -> None:
        for name in sorted(mentions(text) - done):
            if name not in done:
                done.add(name)
                define(tables[name])
                used.append(f"{name} AS ({tables[name]})")

    define(body)
    return ("WITH " + ",\n".join(used) + "\n" if used else "") + body


# --- statements --------------------------------------------------------------


def null_counts(source: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({_q(c)}) AS null_count FROM {source}"
        for c in columns
    )


def _q(name: str) -> str:
    return f'"{name}"'


ITEM_COLUMNS = ("order_id", "order_item_id", "product_id", "price", "shipping_cost")
IP_COLUMNS = (*ITEM_COLUMNS, *MEASURES, "product_category_name")
ORDER_COLUMNS = (
    "order_id", "order_status", *TIMES, *DAYS, "DeliveryTimeStatus", "order_time_of_day",
    "order_purchase_weekend_or_weekday", "delivery_time_of_day", "order_delivered_weekend_or_weekday",
)
BASE_COLUMNS = (
    "review_id", "review_score", "review_creation_date", "review_answer_time", "label",
    "DaysTakenForReview", "review_time_of_day", "review_weekend_or_weekday", "day_of_the_week",
    "month", *ORDER_COLUMNS, "payment_type", "max_payment_sequential", "max_payment_installments",
    "total_payment_value", "total_items", "total_price", "total_shipping_cost", "average_price",
    "average_shipping_cost", *[f"average_{m}" for m in MEASURES[:4]], "total_amount",
    *[f"total_amount_{c}" for c in CATEGORIES],
)


def describe(column: str) -> str:
    return (
        f"SELECT '{column}' AS column_name, count({column}) AS count, "
        f"round(avg(CAST({column} AS DOUBLE)), 4) AS mean, "
        f"round(stddev_samp(CAST({column} AS DOUBLE)), 4) AS stddev, "
        f"CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max FROM order_items"
    )


CATEGORICALS = {
    "order_status": "order_status",
    "DeliveryTimeStatus": "DeliveryTimeStatus",
    "order_time_of_day": "order_time_of_day",
    "order_purchase_weekend_or_weekday": "order_purchase_weekend_or_weekday",
    "delivery_time_of_day": "delivery_time_of_day",
    "order_delivered_weekend_or_weekday": "order_delivered_weekend_or_weekday",
    "payment_type": "payment_type",
    "max_payment_sequential": "payment_sequential",
    "max_payment_installments": "payment_installments",
}


def index_table(column: str) -> str:
    return (
        f"SELECT {_q(column)} AS v, row_number() OVER (ORDER BY count(*) DESC, CAST({_q(column)} AS VARCHAR)) - 1 AS i, "
        f"count(*) OVER () AS size FROM basetable GROUP BY {_q(column)}"
    )


def indexed(shown: dict[str, str], select: str, source: str = "basetable", how: str = "JOIN") -> str:
    """``select`` over the source joined to the index of each categorical."""
    joins = " ".join(
        f"{how} ({index_table(column)}) x_{stem} ON b.{_q(column)} = x_{stem}.v"
        for column, stem in shown.items()
    )
    return f"SELECT {select} FROM {source} b {joins}"


def slots(stem: str, dropped: int = 1) -> str:
    """0 and 1 per slot, as hundredths; the last ``dropped`` categories have none."""
    x = f"x_{stem}"
    return (
        f"array_to_string([CASE WHEN s = coalesce({x}.i, -1) THEN '100' ELSE '0' END "
        f"FOR s IN range({x}.size - {dropped})], ',')"
    )


def hundredths(value: str) -> str:
    return f"CAST({cents(value)} AS VARCHAR)"


BUCKET = "CAST(('0x' || substr(md5('123:' || CAST(order_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000"

ROC = """
  SELECT score, sum(label) AS pos, count(*) - sum(label) AS neg FROM ruled GROUP BY score"""
RULED = """
  SELECT CAST(label AS DOUBLE) AS label, estimated_delivery_days AS score,
         CASE WHEN "DeliveryTimeStatus" <> 'delayed' THEN 1.0 ELSE 0.0 END AS prediction
  FROM basetable"""


SIDES = f"""
  SELECT *, avg(label) FILTER (train) OVER (PARTITION BY early) AS s, avg(label) FILTER (train) OVER () AS all_s
  FROM (SELECT review_id, order_id, label, "DeliveryTimeStatus" = 'early' AS early, {BUCKET} < 7000 AS train FROM basetable)"""


def report(group: str) -> str:
    return with_tables(
        f"SELECT {_q(group)}, count(*) AS reviews, "
        f"CAST(sum(review_score) AS DOUBLE) / count(*) AS average_review_score FROM basetable GROUP BY 1"
    )


def f1_of(label: int) -> str:
    tp = f"sum(CASE WHEN label = {label} AND prediction = {label} THEN 1.0 ELSE 0.0 END)"
    return (
        f"sum(CASE WHEN label = {label} THEN 1.0 ELSE 0.0 END) / count(*) * "
        f"(2.0 * {tp} / (sum(CASE WHEN label = {label} THEN 1.0 ELSE 0.0 END) + "
        f"sum(CASE WHEN prediction = {label} THEN 1.0 ELSE 0.0 END)))"
    )


def statements() -> dict[str, str]:
    w = with_tables
    strong = {"payment_type": "payment_type", "max_payment_installments": "payment_installments"}
    payment = {k: CATEGORICALS[k] for k in ("payment_type", "max_payment_sequential", "max_payment_installments")}
    strong_vector = " || ',' || ".join([
        *[hundredths(c) for c in (
            "estimated_delivery_days", "total_items", "actual_delivered_days", "order_to_approval_days",
            "total_shipping_cost", '"total_amount_ECONOMY"', "average_product_name_lenght",
            '"total_amount_SMALL"')],
        slots("payment_type"), slots("payment_installments"),
    ])
    numeric_vector = " || ',' || ".join(hundredths(_q(c)) for c in (
        *DAYS, "total_payment_value", "total_items", "total_price", "total_shipping_cost",
        "average_price", "average_shipping_cost", *[f"average_{m}" for m in MEASURES[:4]],
        "total_amount", "total_amount_ECONOMY", "total_amount_LARGE",
    ))
    text = "CAST({} AS VARCHAR)".format
    return {
        "scan_csv_roundtrip": w(
            f"SELECT {text('order_id')} AS order_id, order_item_id, {text('product_id')} AS product_id, "
            "price, shipping_cost FROM order_items"),
        "scan_csv_inferred": w("SELECT * FROM order_payments"),
        "scan_csv_permuted": w(
            f"SELECT {text('order_id')} AS order_id, payment_sequential, payment_type, payment_installments, "
            "payment_value FROM order_payments"),
        "scan_csv_rejects": w(
            "SELECT c AS column_name, CASE WHEN c = 'payment_value' THEN (SELECT count(*) FROM order_payments "
            "WHERE payment_sequential = 3) ELSE 0 END AS rejected "
            "FROM (SELECT unnest(['payment_sequential', 'payment_installments', 'payment_value']) AS c)"),
        "scan_csv_escaped":
            f"SELECT {text('p_partkey')} AS product_id, CAST(10 + p_partkey % 30 AS DOUBLE) AS product_length_cm, "
            "'\"' || p_name || '\", ' || p_type AS product_category_name FROM part",
        "table_counts": w(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s}" for t, s in (
                ("order_reviews", "reviews_raw"), ("order_items", "order_items"), ("products", "products"),
                ("orders", "orders_in"), ("order_payments", "order_payments")))),
        "null_profile": w(
            null_counts("everything", IP_COLUMNS), everything=joined("order_items")),
        "null_profile_orders": w(null_counts("orders_text", ("order_id", "order_status", *TIMES))),
        "distinct_profile": w(
            "SELECT count(*) AS row_count, (SELECT count(*) FROM (SELECT DISTINCT * FROM order_items)) AS distinct_rows, "
            "count(DISTINCT order_id) AS distinct_keys FROM order_items"),
        "approx_distinct_keys": w("SELECT count(DISTINCT order_id) AS distinct_keys, true AS within_3_percent FROM order_reviews"),
        "rows_with_name": w(
            "SELECT order_id, order_item_id, product_id, price FROM everything WHERE product_name_lenght IS NOT NULL",
            everything=joined("order_items")),
        "distinct_values": w(" UNION ALL ".join(
            f"SELECT DISTINCT '{c}' AS column_name, {text(c)} AS value FROM order_payments"
            for c in ("payment_type", "payment_installments", "payment_sequential"))),
        "describe_numeric": w(" UNION ALL ".join(map(describe, ("order_item_id", "price", "shipping_cost")))),
        "describe_text": w(" UNION ALL ".join(
            f"SELECT '{raw}' AS column_name, count(*) AS count, min(v) AS min, max(v) AS max FROM "
            f"(SELECT coalesce(CAST({column} AS VARCHAR), 'NA') AS v FROM orders_text)"
            for raw, column in (
                ("order_id", "order_id"), ("order_status", "order_status"),
                ("order_approved_at", "order_approved_at_time")))),
        "nonpositive_probe":
            "SELECT l_orderkey AS order_id, l_extendedprice * l_discount AS price, "
            "l_extendedprice * l_tax AS shipping_cost FROM lineitem "
            "WHERE l_extendedprice * l_discount <= 0 AND l_extendedprice * l_tax <= 0",
        "null_rows": w(
            "SELECT order_id, order_item_id, product_id, price FROM everything WHERE product_name_lenght IS NULL",
            everything=joined("order_items")),
        "duplicate_keys": w(
            "SELECT order_id, count(*) AS count FROM order_items GROUP BY order_id HAVING count(*) > 1"),
        "order_time_casts": w("SELECT * FROM orders_text"),
        "filter_na_token": w("SELECT order_id, order_status FROM orders_text WHERE order_id <> 'NA'"),
        "filter_time_range": w(
            f"SELECT order_id, order_status, order_purchase_time FROM orders_in WHERE {TRAINING}"),
        "delivery_days": w(f"SELECT order_id, {', '.join(DAYS)} FROM days"),
        "delivery_status": w('SELECT order_id, "DeliveryTimeStatus" FROM orders_final'),
        "time_of_day": w("SELECT order_id, order_time_of_day, delivery_time_of_day FROM orders_final"),
        "weekday_flag": w(
            "SELECT order_id, order_purchase_weekend_or_weekday, order_delivered_weekend_or_weekday FROM orders_final"),
        "weekday_flag_calendar": w(
            "SELECT order_id, CASE WHEN isodow(order_purchase_time) < 6 THEN 'weekday' ELSE 'weekend' END AS weekday_flag, "
            "dayname(order_purchase_time) AS day_name FROM orders_in"),
        "order_features": w(
            "SELECT * FROM text_final",
            text_final=orders_final("(SELECT * FROM orders_text WHERE order_id <> 'NA')", TRAINING)),
        "drop_columns": w(f"SELECT * EXCLUDE ({', '.join(TIMES)}) FROM orders_final"),
        "fill_answer_time": w("SELECT * FROM order_reviews"),
        "review_count_histogram": w(
            "SELECT review_count, count(*) AS order_count FROM (SELECT order_id, count(review_id) AS review_count "
            "FROM order_reviews GROUP BY order_id) GROUP BY review_count"),
        "review_count_attach": w(
            "SELECT *, count(review_id) OVER (PARTITION BY order_id) AS review_count FROM order_reviews"),
        "latest_review": w("SELECT * FROM latest"),
        "latest_review_unique": w(
            "SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY order_id "
            "ORDER BY review_answer_time DESC, review_id DESC) AS rn FROM order_reviews) WHERE rn = 1"),
        "review_union": w(
            "SELECT l.*, c.review_count FROM latest l JOIN (SELECT order_id, count(review_id) AS review_count "
            "FROM order_reviews GROUP BY order_id) c USING (order_id)"),
        "sorted_reviews": w("SELECT * FROM order_reviews ORDER BY order_id, review_answer_time, review_id"),
        "first_reviews": w("SELECT * FROM order_reviews ORDER BY review_answer_time, review_id LIMIT 30"),
        "review_label": w(
            "SELECT review_id, review_score, CASE WHEN review_score < 4 THEN 0 ELSE 1 END AS label FROM order_reviews"),
        "review_latency": w(
            f"SELECT review_id, CAST({days('review_answer_time', 'review_creation_date')} AS INTEGER) "
            'AS "DaysTakenForReview" FROM order_reviews'),
        "day_name": w(
            f"SELECT review_id, {day_name('review_answer_time')} AS day_of_the_week FROM order_reviews"),
        "month_name": w(
            f"SELECT order_id, {month_name('order_delivered_customer_date_time')} AS \"month\" FROM orders_in"),
        "review_features": w("SELECT * FROM reviews_final"),
        "dedupe_rows": w("SELECT DISTINCT * FROM order_items"),
        "items_products": w(
            f"SELECT {', '.join(ITEM_COLUMNS)}, {', '.join(f'CAST({m} AS DOUBLE) AS {m}' for m in MEASURES)}, "
            "product_category_name FROM everything", everything=joined("order_items")),
        "impute_mean_distinct": w(f"SELECT product_id, {FILLED_MEASURES} FROM products, means"),
        "impute_mean_rows": w(
            f"SELECT product_id, {FILLED_MEASURES} FROM products, means", means=means("ip_raw", distinct=False)),
        "impute_mode": w(
            "SELECT product_id, coalesce(product_category_name, mode_category) AS product_category_name "
            "FROM products, mode"),
        "order_item_count": w(item_counts("ip")),
        "order_cost_rollup": w(costs("ip")),
        "category_pivot": w(pivot("ip")),
        "category_amounts_long": w(
            f"SELECT order_id, product_category_name AS category, coalesce({total('price + shipping_cost')}, 0) AS amount "
            "FROM ip GROUP BY order_id, product_category_name"),
        "order_items_rollup": w("SELECT * FROM items_final"),
        "payment_minmax": w(
            "SELECT order_id, min_payment_sequential, max_payment_sequential, min_payment_installments, "
            "max_payment_installments FROM facts"),
        "payment_value_rollup": w(
            "SELECT order_id, total_payment_value, average_payment_value, min_payment_value, max_payment_value FROM facts"),
        "payment_first_type": w("SELECT order_id, payment_type FROM facts"),
        "payment_rollup": w("SELECT * FROM payments_final"),
        "payment_agreement": w(" UNION ALL ".join(
            f"SELECT '{name}' AS check_name, count(*) AS row_count FROM facts WHERE {a} = {b}" for name, a, b in (
                ("sequential_min_is_max", "min_payment_sequential", "max_payment_sequential"),
                ("installments_min_is_max", "min_payment_installments", "max_payment_installments"),
                ("total_is_average", "total_payment_value", "average_payment_value"),
                ("total_is_min", "total_payment_value", "min_payment_value"),
                ("total_is_max", "total_payment_value", "max_payment_value")))),
        "basetable_joined": w(null_counts("chain", BASE_COLUMNS)),
        "sentinel_fill": w(f"SELECT review_id, order_id, {', '.join(DAYS)} FROM chain_filled"),
        "basetable": w("SELECT * FROM basetable"),
        "basetable_with_sentinel": w(
            f"SELECT review_id, order_id, {', '.join(DAYS)}, total_amount FROM chain_filled "
            "WHERE order_status IS NOT NULL AND payment_type IS NOT NULL AND total_amount IS NOT NULL"),
        "basetable_holdout": w("SELECT * FROM h_basetable"),
        "basetable_holdout_refit": w(
            "SELECT * FROM h_basetable", ip_raw=joined("h_items"), h_ip_raw=joined("h_items")),
        "holdout_incomplete": w(
            "SELECT (SELECT count(*) FROM h_chain) AS row_count, "
            f"(SELECT count(*) FROM h_chain) - (SELECT count(*) FROM (SELECT * FROM h_chain {ALL_PRESENT})) AS incomplete_rows"),
        "prepared_counts": w(" UNION ALL ".join(
            f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {s}" for t, s in (
                ("order_reviews", "reviews_final"), ("order_items_products_final", "items_final"),
                ("orders", "orders_final"), ("order_payment_final", "payments_final")))),
        "report_delivery_status": report("DeliveryTimeStatus"),
        "report_delivery_time": report("delivery_time_of_day"),
        "report_delivery_weekday": report("order_delivered_weekend_or_weekday"),
        "report_payment_type": report("payment_type"),
        "report_all": w(" UNION ALL ".join(
            f"SELECT '{g}' AS report, {text(_q(g))} AS value, count(*) AS reviews, "
            f"CAST(sum(review_score) AS DOUBLE) / count(*) AS average_review_score FROM basetable GROUP BY {_q(g)}"
            for g in ("DeliveryTimeStatus", "delivery_time_of_day", "order_delivered_weekend_or_weekday", "payment_type"))),
        "report_price_delivery": w(
            f'SELECT review_score, "DeliveryTimeStatus", count(*) AS reviews, {mean("average_price")} AS average_price '
            "FROM basetable GROUP BY 1, 2"),
        "string_index": w(indexed(CATEGORICALS, "b.review_id, b.order_id, " + ", ".join(
            f"CAST(x_{s}.i AS DOUBLE) AS {_q(s + '_Ind')}" for s in CATEGORICALS.values()))),
        "string_index_large": w(
            "SELECT order_id, order_item_id, item_key, CAST(i AS DOUBLE) AS \"item_key_Ind\" FROM keyed JOIN "
            "(SELECT item_key, row_number() OVER (ORDER BY count(*) DESC, item_key) - 1 AS i FROM keyed GROUP BY item_key) USING (item_key)",
            keyed="SELECT order_id, order_item_id, order_id || '-' || order_item_id AS item_key FROM order_items"),
        "one_hot": w(indexed(CATEGORICALS, "b.review_id, b.order_id, " + ", ".join(
            f"{slots(s)} AS {_q(s + '_dum')}" for s in CATEGORICALS.values()))),
        "encode_pipeline": w(
            "SELECT order_id, " + ", ".join(
                f"array_to_string([CASE WHEN s = coalesce(i_{s}, -1) THEN '100' ELSE '0' END "
                f"FOR s IN range((SELECT count(DISTINCT {c}) FROM basetable))], ',') AS {_q(s + '_dum')}"
                for c, s in payment.items())
            + " FROM (" + indexed(payment, "b.order_id, " + ", ".join(
                f"x_{s}.i AS i_{s}" for s in payment.values()), "h_basetable", "LEFT JOIN") + ")"),
        "feature_select": w(
            "SELECT order_id, estimated_delivery_days, total_items, actual_delivered_days, order_to_approval_days, "
            'total_shipping_cost, "total_amount_ECONOMY", average_product_name_lenght, "total_amount_SMALL", label '
            "FROM basetable"),
        "split_train_test": w(
            f"SELECT review_id, order_id, label, CASE WHEN {BUCKET} < 7000 THEN 'train' ELSE 'test' END AS side FROM basetable"),
        "assemble_features": w(indexed(strong, f"b.order_id, b.label, {strong_vector} AS features")),
        "assemble_holdout": w(f"SELECT order_id, {numeric_vector} AS features FROM h_basetable"),
        "metric_auc": w(
            "SELECT 'area_under_roc' AS metric, round(sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)), 9) AS value "
            "FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) "
            "AS below FROM roc)", ruled=RULED, roc=ROC),
        "metric_pr": w(
            "SELECT 'area_under_pr' AS metric, round(sum((r - coalesce(r0, 0)) * (p + coalesce(p0, p)) / 2), 9) AS value "
            "FROM (SELECT r, p, lag(r) OVER (ORDER BY score DESC) AS r0, lag(p) OVER (ORDER BY score DESC) AS p0 "
            "FROM (SELECT score, sum(pos) OVER d / (SELECT sum(pos) FROM roc) AS r, "
            "sum(pos) OVER d / (sum(pos) OVER d + sum(neg) OVER d) AS p FROM roc WINDOW d AS (ORDER BY score DESC)))",
            ruled=RULED, roc=ROC),
        "metric_accuracy_f1": w(
            "SELECT 'accuracy' AS metric, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS value FROM ruled "
            f"UNION ALL SELECT 'f1', round(CAST({f1_of(0)} + {f1_of(1)} AS DOUBLE), 9) FROM ruled", ruled=RULED),
        "metric_curves": w(
            "SELECT curve, round(score / 100, 9) AS threshold, round(x, 9) AS x, round(y, 9) AS y FROM ("
            "SELECT 'roc' AS curve, score, CAST(fp AS DOUBLE) / n AS x, CAST(tp AS DOUBLE) / p AS y FROM points "
            "UNION ALL SELECT 'pr', score, CAST(tp AS DOUBLE) / p, CAST(tp AS DOUBLE) / (tp + fp) FROM points)",
            ruled=RULED, roc=ROC,
            points="SELECT score, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, (SELECT sum(pos) FROM roc) AS p, "
            "(SELECT sum(neg) FROM roc) AS n FROM roc WINDOW d AS (ORDER BY score DESC)"),
        "split_random": w("SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_overlap FROM basetable"),
        "tree_rows": w(f"SELECT order_id, label FROM basetable WHERE {BUCKET} >= 7000"),
        "score_reloaded": w("SELECT order_id, true AS same FROM h_basetable"),
        "score_rows": w("SELECT order_id, 1 AS is_class FROM h_basetable"),
        "importance_total": w(
            f"SELECT CAST({len(DAYS) + 11 + len(CATEGORIES)} + " + " + ".join(
                f"(SELECT count(DISTINCT {_q(c)}) - 1 FROM basetable)" for c in CATEGORICALS)
            + " AS BIGINT) AS features, 1.0::DOUBLE AS total"),
        "tree_cv_folds": w(
            f"SELECT CAST(d AS INTEGER) AS max_depth, (SELECT count(*) FROM basetable WHERE {BUCKET} < 7000) AS n_rows, true AS agrees "
            "FROM (SELECT unnest([2, 5]) AS d)"),
        "importance_splits": w(
            f"SELECT CAST({len(DAYS) + 11 + len(CATEGORIES)} + " + " + ".join(
                f"(SELECT count(DISTINCT {_q(c)}) - 1 FROM basetable)" for c in CATEGORICALS)
            + " AS BIGINT) AS features, CAST(0 AS BIGINT) AS scores_apart, CAST(0 AS BIGINT) AS places_apart"),
        "logreg_gradient": w(
            "SELECT CAST(9 + " + " + ".join(f"(SELECT count(DISTINCT {_q(c)}) - 1 FROM basetable)" for c in strong)
            + " AS BIGINT) AS slots, CAST(0 AS BIGINT) AS not_zero"),
        "tree_stump": w(
            "SELECT review_id, order_id, CAST(CASE WHEN s > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction, "
            "round(CASE WHEN (least_s > 0.5) = (most_s > 0.5) THEN all_s ELSE s END, 6) AS share "
            "FROM (SELECT *, min(s) OVER () AS least_s, max(s) OVER () AS most_s FROM sides) WHERE NOT train", sides=SIDES),
        "logreg_indicator": w("SELECT review_id, order_id, round(s, 4) AS share FROM sides WHERE NOT train", sides=SIDES),
    }
