"""Registered queries: every operator run over the whole given tables.

Each takes (spark, folder of the Parquet tables) and returns a DataFrame.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from orderloom.functions import calendar
from orderloom.ml import encode, index, metrics, models, score, split
from orderloom.operators import basetable, clean, items, orders, payments, profile, reports, reviews
from orderloom.session import cut_lineage, shared_path
from orderloom.sources import schemas, standin, tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

#: The stand-in categories that take the place of the two strong retail ones.
STRONG = ("ECONOMY", "SMALL")


def query(function: Query, name: str | None = None) -> Query:
    REGISTRY[name or function.__name__] = function
    return function


def _numbers(df: DataFrame, names) -> DataFrame:
    """Nullable whole numbers as doubles, so that null means the same everywhere."""
    return clean.to_double(df, names)


# --- sources -----------------------------------------------------------------


@query
def scan_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "order_items.csv")
    tables.write_csv(standin.order_items(spark, sf), path)
    return tables.read_csv_table(spark, path, "order_items")


@query
def scan_csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "order_payments.csv")
    tables.write_csv(standin.order_payments(spark, sf), path)
    return tables.read_csv_table(spark, path, "order_payments", infer=True).select(
        F.col("order_id").cast("bigint").alias("order_id"),
        "payment_sequential", "payment_type", "payment_installments", "payment_value",
    )


@query
def scan_csv_escaped(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "products.csv")
    quoted = F.concat(F.lit('"'), F.col("p_name"), F.lit('", '), F.col("p_type"))
    source = standin.products_of(standin.load(spark, sf, "part"), category=quoted)
    tables.write_csv(source, path, doubled_quotes=True)
    read = tables.read_csv_table(spark, path, "products")
    return read.select("product_id", "product_length_cm", schemas.CATEGORY)


@query
def scan_csv_permuted(spark: SparkSession, sf: str) -> DataFrame:
    """A file with its columns in another order, and one column too many."""
    path = shared_path(spark, "order_payments.csv")
    given = standin.order_payments(spark, sf).withColumn("note", F.lit("x"))
    tables.write_csv(given.select(*reversed(given.columns)), path)
    return tables.read_csv_table(spark, path, "order_payments")


@query
def scan_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Fields that are no numbers, counted by column."""
    path = shared_path(spark, "order_payments.csv")
    given = standin.order_payments(spark, sf).withColumn(
        "payment_value",
        F.when(F.col("payment_sequential") == 2, "NA").when(F.col("payment_sequential") == 3, "12,5").otherwise(F.col("payment_value").cast("string")),
    )
    tables.write_csv(given, path)
    return tables.csv_rejects(spark, path, schemas.ORDER_PAYMENTS)


# --- profiles ----------------------------------------------------------------


@query
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    given = standin.training_tables(spark, sf)
    return profile.row_counts({name: getattr(given, name) for name in schemas.BY_TABLE})


@query
def null_profile(spark: SparkSession, sf: str) -> DataFrame:
    joined = items.with_products(standin.order_items(spark, sf), standin.products(spark, sf))
    return profile.null_counts(joined)


@query
def null_profile_orders(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_counts(orders.cast_order_times(standin.orders_as_text(spark, sf)))


@query
def distinct_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_counts(standin.order_items(spark, sf), "order_id")


@query
def approx_distinct_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys counted by one sketch a day, stored and merged, against the exact count."""
    rows = standin.order_reviews(spark, sf)
    sketches = cut_lineage(profile.key_sketches(rows, "order_id", "review_creation_date"))
    estimate = profile.approx_distinct_keys(sketches).withColumnRenamed("distinct_keys", "estimate")
    exact = rows.agg(F.countDistinct("order_id").alias("distinct_keys"))
    close = F.abs(F.col("estimate") - F.col("distinct_keys")) <= 0.03 * F.col("distinct_keys")
    return exact.crossJoin(estimate).select("distinct_keys", close.alias("within_3_percent"))


@query
def rows_with_name(spark: SparkSession, sf: str) -> DataFrame:
    joined = items.with_products(standin.order_items(spark, sf), standin.products(spark, sf))
    return clean.rows_having(joined, "product_name_lenght").select("order_id", "order_item_id", "product_id", "price")


@query
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(
        standin.order_payments(spark, sf),
        ["payment_type", "payment_installments", "payment_sequential"],
    )


@query
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    summary = profile.describe(standin.order_items(spark, sf), ["order_item_id", "price", "shipping_cost"])
    return summary.withColumns({name: F.round(name, 4) for name in ("mean", "stddev")})


@query
def describe_text(spark: SparkSession, sf: str) -> DataFrame:
    return profile.describe_text(
        standin.orders_as_text(spark, sf), ["order_id", "order_status", "order_approved_at"]
    )


@query
def nonpositive_probe(spark: SparkSession, sf: str) -> DataFrame:
    """Rebates and taxes as amounts: some line items have neither."""
    charges = standin.load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("shipping_cost"),
    )
    return clean.nonpositive_rows(charges, ["price", "shipping_cost"])


@query
def null_rows(spark: SparkSession, sf: str) -> DataFrame:
    joined = items.with_products(standin.order_items(spark, sf), standin.products(spark, sf))
    return clean.rows_missing(joined, "product_name_lenght").select(
        "order_id", "order_item_id", "product_id", "price"
    )


@query
def duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_keys(standin.order_items(spark, sf), "order_id")


# --- orders ------------------------------------------------------------------


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return orders.prepare_orders(standin.orders(spark, sf), standin.TRAINING)


@query
def order_time_casts(spark: SparkSession, sf: str) -> DataFrame:
    return orders.cast_order_times(standin.orders_as_text(spark, sf))


@query
def filter_na_token(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_na_keys(standin.orders_as_text(spark, sf)).select("order_id", "order_status")


@query
def filter_time_range(spark: SparkSession, sf: str) -> DataFrame:
    timed = orders.cast_order_times(standin.orders(spark, sf))
    return clean.in_time_range(timed, "order_purchase_time", *standin.TRAINING).select(
        "order_id", "order_status", "order_purchase_time"
    )


@query
def delivery_days(spark: SparkSession, sf: str) -> DataFrame:
    timed = orders.cast_order_times(standin.orders(spark, sf))
    return orders.add_delivery_days(timed).select("order_id", *clean.DAY_COUNTS)


@query
def delivery_status(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).select("order_id", "DeliveryTimeStatus")


@query
def time_of_day(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).select("order_id", "order_time_of_day", "delivery_time_of_day")


@query
def weekday_flag(spark: SparkSession, sf: str) -> DataFrame:
    return _orders(spark, sf).select(
        "order_id", "order_purchase_weekend_or_weekday", "order_delivered_weekend_or_weekday"
    )


@query
def weekday_flag_calendar(spark: SparkSession, sf: str) -> DataFrame:
    timed = orders.cast_order_times(standin.orders(spark, sf))
    bought = F.col("order_purchase_time")
    return timed.select(
        "order_id",
        calendar.weekday_flag(bought, "calendar").alias("weekday_flag"),
        calendar.day_name(bought, "calendar").alias("day_name"),
    )


@query
def order_features(spark: SparkSession, sf: str) -> DataFrame:
    """The whole prepared orders table, from text with missing-value tokens."""
    return orders.prepare_orders(standin.orders_as_text(spark, sf), standin.TRAINING)


@query
def drop_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Column names to drop match whatever their case."""
    return _orders(spark, sf).drop(*[name.upper() for name in orders.TIMES.values()])


# --- reviews -----------------------------------------------------------------


def _reviews(spark: SparkSession, sf: str) -> DataFrame:
    timed = clean.cast_times(standin.order_reviews(spark, sf), reviews.TIMES)
    return reviews.fill_answer_time(timed)


@query
def fill_answer_time(spark: SparkSession, sf: str) -> DataFrame:
    return _reviews(spark, sf)


@query
def review_count_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.review_count_histogram(_reviews(spark, sf))


@query
def review_count_attach(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.attach_review_count(_reviews(spark, sf))


@query
def latest_review(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.latest_reviews(_reviews(spark, sf))


@query
def latest_review_unique(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.latest_review_unique(_reviews(spark, sf))


@query
def review_union(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.single_and_latest(_reviews(spark, sf))


@query
def sorted_reviews(spark: SparkSession, sf: str) -> DataFrame:
    return _reviews(spark, sf).orderBy("order_id", "review_answer_time", "review_id")


@query
def first_reviews(spark: SparkSession, sf: str) -> DataFrame:
    """Preview: the thirty earliest answers."""
    return _reviews(spark, sf).orderBy("review_answer_time", "review_id").limit(30)


def _review_features(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.add_review_features(_reviews(spark, sf))


@query
def review_label(spark: SparkSession, sf: str) -> DataFrame:
    return _review_features(spark, sf).select("review_id", "review_score", "label")


@query
def review_latency(spark: SparkSession, sf: str) -> DataFrame:
    return _review_features(spark, sf).select("review_id", "DaysTakenForReview")


@query
def day_name(spark: SparkSession, sf: str) -> DataFrame:
    return _review_features(spark, sf).select("review_id", "day_of_the_week")


@query
def month_name(spark: SparkSession, sf: str) -> DataFrame:
    """Months of orders; the review events cover too few of them."""
    timed = orders.cast_order_times(standin.orders(spark, sf))
    return timed.select(
        "order_id", calendar.month_name(F.col("order_delivered_customer_date_time")).alias("month")
    )


@query
def review_features(spark: SparkSession, sf: str) -> DataFrame:
    return reviews.prepare_reviews(standin.order_reviews(spark, sf))


# --- items and products ------------------------------------------------------


def _stats(spark: SparkSession, sf: str, **options) -> items.ItemStats:
    return items.fit_item_stats(standin.order_items(spark, sf), standin.products(spark, sf), **options)


def _items(spark: SparkSession, sf: str) -> tuple[DataFrame, items.ItemStats]:
    source = items.shared_items(standin.order_items(spark, sf)), standin.products(spark, sf)
    stats = items.fit_item_stats(*source)
    return items.prepare_items(*source, stats), stats


@query
def dedupe_rows(spark: SparkSession, sf: str) -> DataFrame:
    return clean.dedupe(standin.order_items(spark, sf))


@query
def items_products(spark: SparkSession, sf: str) -> DataFrame:
    joined = items.with_products(standin.order_items(spark, sf), standin.products(spark, sf))
    return _numbers(joined, schemas.PRODUCT_MEASURES)


def _catalogue(spark: SparkSession, sf: str, stats: items.ItemStats) -> DataFrame:
    return stats.fill(standin.products(spark, sf))


@query
def impute_mean_distinct(spark: SparkSession, sf: str) -> DataFrame:
    filled = _catalogue(spark, sf, _stats(spark, sf, wide=False))
    return filled.select("product_id", *schemas.PRODUCT_MEASURES)


@query
def impute_mean_rows(spark: SparkSession, sf: str) -> DataFrame:
    filled = _catalogue(spark, sf, _stats(spark, sf, distinct_means=False, wide=False))
    return filled.select("product_id", *schemas.PRODUCT_MEASURES)


@query
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    return _catalogue(spark, sf, _stats(spark, sf, wide=False)).select("product_id", schemas.CATEGORY)


@query
def order_item_count(spark: SparkSession, sf: str) -> DataFrame:
    source = standin.order_items(spark, sf), standin.products(spark, sf)
    return items.items_counted(items.prepare_items(*source, items.ItemStats({}, None)))


@query
def order_cost_rollup(spark: SparkSession, sf: str) -> DataFrame:
    source = items.shared_items(standin.order_items(spark, sf)), standin.products(spark, sf)
    stats = items.fit_item_stats(*source, wide=False)
    return items.order_costs(items.prepare_items(*source, stats))


@query
def category_pivot(spark: SparkSession, sf: str) -> DataFrame:
    prepared, stats = _items(spark, sf)
    return items.category_amounts(prepared, stats.categories)


@query
def category_amounts_long(spark: SparkSession, sf: str) -> DataFrame:
    stats = _stats(spark, sf, wide=False)
    source = standin.order_items(spark, sf), standin.products(spark, sf)
    return items.category_amounts_long(items.prepare_items(*source, stats))


@query
def order_items_rollup(spark: SparkSession, sf: str) -> DataFrame:
    prepared, stats = _items(spark, sf)
    return items.items_per_order(prepared, stats.categories)


# --- payments ----------------------------------------------------------------


def _payments(spark: SparkSession, sf: str) -> DataFrame:
    return payments.payment_facts(standin.order_payments(spark, sf))


@query
def payment_minmax(spark: SparkSession, sf: str) -> DataFrame:
    return _payments(spark, sf).select(
        "order_id",
        "min_payment_sequential", "max_payment_sequential",
        "min_payment_installments", "max_payment_installments",
    )


@query
def payment_value_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return _payments(spark, sf).select(
        "order_id",
        "total_payment_value", "average_payment_value", "min_payment_value", "max_payment_value",
    )


@query
def payment_first_type(spark: SparkSession, sf: str) -> DataFrame:
    return _payments(spark, sf).select("order_id", "payment_type")


@query
def payment_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return payments.payments_per_order(standin.order_payments(spark, sf))


@query
def payment_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return payments.payment_agreement(standin.order_payments(spark, sf))


# --- base tables -------------------------------------------------------------


def _fitted(spark: SparkSession, sf: str) -> tuple[basetable.OrderParts, items.ItemStats]:
    """Training parts, and the statistics that they were prepared with."""
    given = basetable.with_shared_items(standin.training_tables(spark, sf))
    stats = basetable.fit_shared_stats(given)
    return basetable.prepare_parts(given, stats, standin.TRAINING), stats


def _training_parts(spark: SparkSession, sf: str) -> basetable.OrderParts:
    return _fitted(spark, sf)[0]


def _basetable(spark: SparkSession, sf: str) -> DataFrame:
    return basetable.build_basetable(_training_parts(spark, sf))


@query
def basetable_joined(spark: SparkSession, sf: str) -> DataFrame:
    """Null counts of the joined table before anything is filled or dropped."""
    return profile.null_counts(basetable.join_parts(_training_parts(spark, sf)))


@query
def sentinel_fill(spark: SparkSession, sf: str) -> DataFrame:
    filled = clean.fill_missing_days(basetable.join_parts(_training_parts(spark, sf)))
    return filled.select("review_id", "order_id", *clean.DAY_COUNTS)


query(_basetable, name="basetable")


@query
def basetable_with_sentinel(spark: SparkSession, sf: str) -> DataFrame:
    """Only the key of each part is required, so missing day counts stay as 99999."""
    kept = basetable.build_basetable(
        _training_parts(spark, sf), ["order_status", "payment_type", "total_amount"]
    )
    return kept.select("review_id", "order_id", *clean.DAY_COUNTS, "total_amount")


@query
def basetable_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return basetable.holdout_basetable(
        standin.holdout_tables(spark, sf), _stats(spark, sf), standin.HOLDOUT
    )


@query
def basetable_holdout_refit(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics fitted on the holdout's own items, copies included."""
    given = standin.holdout_tables(spark, sf)
    stats = items.fit_item_stats(given.order_items, given.products, dedupe_items=False)
    return basetable.holdout_basetable(given, stats, standin.HOLDOUT)


@query
def holdout_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    """How many holdout orders cannot be scored."""
    parts = basetable.prepare_parts(
        standin.holdout_tables(spark, sf), _stats(spark, sf), standin.HOLDOUT
    )
    return basetable.incomplete_rows_count(basetable.join_parts(parts))


@query
def prepared_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Row counts of the prepared tables, ahead of the joins."""
    parts = _training_parts(spark, sf)
    return profile.row_counts({
        "order_reviews": parts.reviews,
        "order_items_products_final": parts.items,
        "orders": parts.orders,
        "order_payment_final": parts.payments,
    })


# --- reports -----------------------------------------------------------------


@query
def report_delivery_status(spark: SparkSession, sf: str) -> DataFrame:
    return reports.review_score_by(_basetable(spark, sf), "DeliveryTimeStatus")


@query
def report_delivery_time(spark: SparkSession, sf: str) -> DataFrame:
    return reports.review_score_by(_basetable(spark, sf), "delivery_time_of_day")


@query
def report_delivery_weekday(spark: SparkSession, sf: str) -> DataFrame:
    return reports.review_score_by(_basetable(spark, sf), "order_delivered_weekend_or_weekday")


@query
def report_payment_type(spark: SparkSession, sf: str) -> DataFrame:
    return reports.review_score_by(_basetable(spark, sf), "payment_type")


@query
def report_all(spark: SparkSession, sf: str) -> DataFrame:
    """The four reports of review scores from one base table and one pass over it."""
    return reports.review_scores_by(_basetable(spark, sf), [
        "DeliveryTimeStatus", "delivery_time_of_day", "order_delivered_weekend_or_weekday", "payment_type"
    ])


@query
def report_price_delivery(spark: SparkSession, sf: str) -> DataFrame:
    return reports.average_price_by_score(_basetable(spark, sf))


# --- encoding and splits -----------------------------------------------------


def _stored(df: DataFrame, *names: str) -> DataFrame:
    """The columns behind a checkpoint, for fits that read them repeatedly."""
    return cut_lineage(df.select(*names))


def _digits(vector: Column) -> Column:
    """A vector as text of whole hundredths, to compare it slot by slot."""
    hundredths = F.transform(vector_to_array(vector), lambda x: F.round(x * 100).cast("bigint"))
    return F.array_join(hundredths.cast("array<string>"), ",")


def _model_rows(spark: SparkSession, sf: str, strong: bool = False) -> DataFrame:
    base = _basetable(spark, sf)
    found = [name.removeprefix(items.AMOUNT_PREFIX) for name in base.columns
             if name.startswith(items.AMOUNT_PREFIX)]
    names = encode.strong_columns(STRONG) if strong else encode.model_columns(found)
    rows = _stored(base, *encode.raw_columns(base, names))
    fitted = encode.encoder(encode.used_categoricals(names)).fit(rows)
    return encode.select_columns(encode.encode(rows, fitted), names)


@query
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored(_basetable(spark, sf), "review_id", "order_id", *encode.CATEGORICALS)
    indexer = encode.encoder().getStages()[0].fit(rows)
    return indexer.transform(rows).select("review_id", "order_id", *indexer.getOutputCols())


@query
def string_index_large(spark: SparkSession, sf: str) -> DataFrame:
    """The index of a column with nearly as many values as rows."""
    rows = _stored(standin.order_items(spark, sf).withColumn("item_key", F.concat_ws("-", "order_id", "order_item_id")), "order_id", "order_item_id", "item_key")
    return index.with_index(rows, index.value_index(rows, "item_key"), "item_key", "item_key_Ind")


@query
def one_hot(spark: SparkSession, sf: str) -> DataFrame:
    rows = _stored(_basetable(spark, sf), "review_id", "order_id", *encode.CATEGORICALS)
    encoded = encode.encoder().fit(rows).transform(rows)
    names = [stem + encode.DUMMY for stem in encode.CATEGORICALS.values()]
    return encoded.select("review_id", "order_id", *[_digits(F.col(n)).alias(n) for n in names])


@query
def encode_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    """Fitted on training rows with a slot for unseen values, applied to the holdout."""
    parts, stats = _fitted(spark, sf)
    rows = _stored(basetable.build_basetable(parts), *encode.PAYMENT_CATEGORICALS)
    fitted = encode.encoder(encode.PAYMENT_CATEGORICALS, unseen="keep").fit(rows)
    holdout = basetable.holdout_basetable(standin.holdout_tables(spark, sf), stats, standin.HOLDOUT)
    encoded = fitted.transform(holdout)
    names = [stem + encode.DUMMY for stem in encode.PAYMENT_CATEGORICALS.values()]
    return encoded.select("order_id", *[_digits(F.col(n)).alias(n) for n in names])


@query
def feature_select(spark: SparkSession, sf: str) -> DataFrame:
    names = [name for name in encode.strong_columns(STRONG) if not name.endswith(encode.DUMMY)]
    return encode.select_columns(_basetable(spark, sf), names)


@query
def split_train_test(spark: SparkSession, sf: str) -> DataFrame:
    # Both sides read the rows: stored, the base table is made once.
    train, test = split.split_by_key(_stored(_basetable(spark, sf), "review_id", "order_id", "label"))
    return train.withColumn("side", F.lit("train")).unionByName(
        test.withColumn("side", F.lit("test"))
    )


@query
def split_random(spark: SparkSession, sf: str) -> DataFrame:
    """A split by row sampling: rows on both sides together, and rows on both sides at once."""
    rows = _stored(_basetable(spark, sf), "review_id")
    train, test = split.split_at_random(rows)
    both = train.join(test, "review_id").agg(F.count("*").alias("n_overlap"))
    return train.unionByName(test).agg(F.count("*").alias("n_rows")).crossJoin(both)


@query
def assemble_features(spark: SparkSession, sf: str) -> DataFrame:
    """The ten strongest features by a formula fitted on the training side."""
    rows = _model_rows(spark, sf, strong=True)
    train, _ = split.split_by_key(rows)
    assembled = encode.fit_formula(train).transform(rows)
    return assembled.select(
        "order_id", F.col("label").cast("int").alias("label"), _digits(F.col("features")).alias("features")
    )


@query
def assemble_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """All numeric features of the holdout by an assembler."""
    rows = basetable_holdout(spark, sf)
    numeric = [name for name in encode.model_columns(("ECONOMY", "LARGE"), labelled=False)
               if not name.endswith(encode.DUMMY)]
    assembled = encode.assemble(encode.select_columns(rows, numeric))
    return assembled.select("order_id", _digits(F.col("features")).alias("features"))


# --- models ------------------------------------------------------------------


def _sides(spark: SparkSession, sf: str, strong: bool = False) -> tuple[DataFrame, DataFrame]:
    """Assembled (train, test), by a formula fitted on the training side."""
    train, test = split.split_by_key(_model_rows(spark, sf, strong))
    formula = encode.fit_formula(train)
    keep = ["order_id", "label", "features"]
    return formula.transform(train).select(*keep), formula.transform(test).select(*keep)


_PREDICTED = ("order_id", "label", "prediction")


@query
def tree_predict(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _sides(spark, sf)
    return models.fit_tree(train).transform(test).select(*_PREDICTED)


def _evaluated(spark: SparkSession, sf: str) -> tuple[score.Scorer, DataFrame]:
    """The scorer and its test side: the one model that is evaluated and that scores."""
    return score.fit_with_test(standin.training_tables(spark, sf), standin.TRAINING, STRONG)


@query
def tree_predict_top10(spark: SparkSession, sf: str) -> DataFrame:
    scorer, test = _evaluated(spark, sf)
    return scorer.tree.transform(test).select(*_PREDICTED)


@query
def tree_cv(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _sides(spark, sf, strong=True)
    return models.cross_validation_report(models.cross_validate_tree(train), spark)


@query
def tree_cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    """Each reported average against the rank sums of stored predictions: rows and whether they agree."""
    train, _ = _sides(spark, sf, strong=True)
    train = cut_lineage(train)
    fitted = models.cross_validate_tree(train)
    predictions = models.fold_predictions(fitted, train)
    again = models.recomputed_averages(predictions)
    reported = models.cross_validation_report(fitted, spark)
    found = spark.createDataFrame(list(again.items()), "max_depth int, recomputed double")
    counted = predictions.groupBy("max_depth").agg(F.count("*").alias("n_rows"))
    agrees = (F.abs(F.col("average_auc") - F.col("recomputed")) < 1e-9).alias("agrees")
    return reported.join(found, "max_depth").join(counted, "max_depth").select("max_depth", "n_rows", agrees)


@query
def tree_cv_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """The cross-validated tree on the test side."""
    train, test = _sides(spark, sf, strong=True)
    return metrics.evaluate(models.cross_validate_tree(train).bestModel.transform(test))


@query
def tree_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    scorer, test = _evaluated(spark, sf)
    return metrics.evaluate(scorer.tree.transform(test))


@query
def tree_evaluate_full(spark: SparkSession, sf: str) -> DataFrame:
    """The tree over all features on the test side."""
    train, test = _sides(spark, sf)
    return metrics.evaluate(models.fit_tree(train).transform(test))


def _indicator(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) with one feature: whether the order was delivered early."""
    early = (F.col("DeliveryTimeStatus") == calendar.EARLY).cast("double").alias("early")
    rows = _stored(_basetable(spark, sf).withColumn("early", early), "review_id", "order_id", "label", "early")
    return split.split_by_key(encode.VectorAssembler(inputCols=["early"], outputCol="features").transform(rows))


@query
def tree_stump(spark: SparkSession, sf: str) -> DataFrame:
    """A tree over one indicator, whose predictions SQL can state."""
    train, test = _indicator(spark, sf)
    scored = models.fit_tree(train, maxDepth=1).transform(test)
    share = F.round(vector_to_array("probability")[1], 6).alias("share")
    return scored.select("review_id", "order_id", "prediction", share)


@query
def logreg_indicator(spark: SparkSession, sf: str) -> DataFrame:
    """Logistic regression over one indicator: its probabilities are the means of two groups."""
    train, test = _indicator(spark, sf)
    scored = models.with_score(models.fit_logistic(train, tol=1e-12, maxIter=200, standardization=False), test)
    return scored.select("review_id", "order_id", F.round("score", 4).alias("share"))


@query
def tree_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that get a prediction, with their label."""
    return tree_predict_top10(spark, sf).select("order_id", F.col("label").cast("int").alias("label"))


@query
def score_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The orders that get a score, and whether each score is a class."""
    return score_output(spark, sf).select("order_id", F.col("prediction").isin(0.0, 1.0).cast("int").alias("is_class"))


@query
def importance_total(spark: SparkSession, sf: str) -> DataFrame:
    """Number of features of the full tree, and the sum of their importance."""
    train, _ = _sides(spark, sf)
    every = models.feature_importance(models.fit_tree(train), train, top=10_000)
    return every.agg(F.count("*").alias("features"), F.round(F.sum("score"), 6).alias("total"))


@query
def importance_splits(spark: SparkSession, sf: str) -> DataFrame:
    """Importance from the tree's table of splits against the model's: scores and places that differ."""
    train, _ = _sides(spark, sf)
    model = models.fit_tree(train)
    own = models.importance_of_splits(models.tree_splits(model, train)).withColumnRenamed("score", "won").drop("name")
    every = models.feature_importance(model, train, top=10_000).join(own, "idx", "left").fillna(0.0, ["won"])
    place = lambda c: F.row_number().over(Window.orderBy(F.round(c, 9).desc(), "idx"))  # noqa: E731 - one row for each slot
    ranked = every.withColumns({"by_model": place("score"), "by_splits": place("won")})
    return ranked.agg(
        F.count("*").alias("features"), F.count_if(F.abs(F.col("score") - F.col("won")) > 1e-9).alias("scores_apart"),
        F.count_if((F.col("by_model") <= 30) & (F.col("by_model") != F.col("by_splits"))).alias("places_apart"),
    )


@query
def feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _sides(spark, sf)
    return models.feature_importance(models.fit_tree(train), train)


@query
def logreg_predict(spark: SparkSession, sf: str) -> DataFrame:
    train, test = _sides(spark, sf)
    return models.fit_logistic(train).transform(test).select(*_PREDICTED)


@query
def logreg_report(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _sides(spark, sf)
    return models.logistic_report(models.fit_logistic(train), train)


@query
def logreg_gradient(spark: SparkSession, sf: str) -> DataFrame:
    """The score equations of a fit to the end: slots, and those whose gradient is not zero."""
    train, _ = _sides(spark, sf, strong=True)
    train = cut_lineage(train)
    equations = models.score_equations(models.fit_logistic(train, tol=1e-10, maxIter=300), train)
    return equations.agg(F.count("*").alias("slots"), F.count_if(F.abs("gradient") > 1e-4).alias("not_zero"))


@query
def logreg_curves(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _sides(spark, sf)
    return models.logistic_curves(models.fit_logistic(train), train)


@query
def logreg_evaluate(spark: SparkSession, sf: str) -> DataFrame:
    """The logistic model on the test side."""
    train, test = _sides(spark, sf)
    return metrics.evaluate(models.fit_logistic(train).transform(test))


@query
def logreg_summary(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = _sides(spark, sf)
    return models.training_summary(models.fit_logistic(train), spark)


def _ruled(spark: SparkSession, sf: str) -> DataFrame:
    """A rule in place of a model, so that the metrics have known inputs."""
    return _basetable(spark, sf).select(
        F.col("label").cast("double").alias("label"),
        F.col("estimated_delivery_days").alias("score"),
        (F.col("DeliveryTimeStatus") != calendar.DELAYED).cast("double").alias("prediction"),
    )


@query
def metric_curves(spark: SparkSession, sf: str) -> DataFrame:
    """Both curves of a score between 0 and 1, point by point."""
    ruled = _ruled(spark, sf).withColumn("score", F.col("score") / 100)
    points = metrics.curves(ruled)
    return points.select("curve", *[F.round(c, 9).alias(c) for c in ("threshold", "x", "y")])


@query
def metric_auc(spark: SparkSession, sf: str) -> DataFrame:
    ruled = _ruled(spark, sf)
    return metrics.as_table(ruled, {"area_under_roc": round(metrics.rank_sum_area(ruled), 9)})


@query
def metric_pr(spark: SparkSession, sf: str) -> DataFrame:
    ruled = _ruled(spark, sf)
    value = metrics.area(ruled, "areaUnderPR", score="score", bins=0)
    return metrics.as_table(ruled, {"area_under_pr": round(value, 9)})


@query
def metric_accuracy_f1(spark: SparkSession, sf: str) -> DataFrame:
    ruled = _ruled(spark, sf)
    values = {name: round(value, 9) for name, value in metrics.shares(ruled).items()}
    return metrics.as_table(ruled, values)


@query
def score_output(spark: SparkSession, sf: str) -> DataFrame:
    """Fit on training tables, score the holdout, write the result and read it back."""
    scorer, _ = _evaluated(spark, sf)
    path = shared_path(spark, "scores")
    tables.write_scores(scorer.score(standin.holdout_tables(spark, sf), standin.HOLDOUT), path)
    return spark.read.parquet(path)


@query
def score_reloaded(spark: SparkSession, sf: str) -> DataFrame:
    """Every holdout order, and whether a scorer that was saved and loaded says the same."""
    scorer, _ = _evaluated(spark, sf)
    path = shared_path(spark, "scorer")
    scorer.save(path)
    given = standin.holdout_tables(spark, sf)
    first = scorer.score(given, standin.HOLDOUT)
    again = score.load_scorer(spark, path).score(given, standin.HOLDOUT).withColumnRenamed("prediction", "again")
    return first.join(again, "order_id", "full").select("order_id", (F.col("prediction") == F.col("again")).alias("same"))
