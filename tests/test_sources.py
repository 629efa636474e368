from __future__ import annotations

import pytest
from conftest import rows, ts

from orderloom import session
from orderloom.sources import schemas, tables

PRODUCT = ("p1", 10, 100, 1, 5, 1, 1, 1, 'large "round", red')


def test_doubled_quotes(spark, tmp_path):
    text = 'product_id,product_category_name\np1,"large ""round"", red"\n'
    (tmp_path / "products.csv").write_text(text)
    path = str(tmp_path / "products.csv")
    schema = "product_id string, product_category_name string"
    assert rows(tables.read_csv(spark, path, schema, doubled_quotes=True)) == [("p1", 'large "round", red')]
    assert rows(tables.read_csv(spark, path, doubled_quotes=True)) == [("p1", 'large "round", red')]


def test_written_quotes_come_back(spark, tmp_path):
    df = spark.createDataFrame([PRODUCT], schemas.PRODUCTS)
    path = str(tmp_path / "products")
    tables.write_csv(df, path, doubled_quotes=True)
    assert rows(tables.read_csv_table(spark, path, "products")) == [PRODUCT]


def csv(tmp_path, text):
    (tmp_path / "given.csv").write_text(text)
    return str(tmp_path / "given.csv")


def test_columns_are_found_by_name(spark, tmp_path):
    path = csv(tmp_path, "payment_type,extra,payment_sequential,order_id,payment_value,payment_installments\ncard,e,1,o,2.5,3\n")
    assert rows(tables.read_csv_table(spark, path, "order_payments")) == [("o", 1, "card", 3, 2.5)]
    with pytest.raises(ValueError, match="payment_value"):
        tables.read_csv_table(spark, csv(tmp_path, "order_id,payment_type,payment_sequential,payment_installments\n"), "order_payments")


def test_numbers_keep_their_value_and_rejects_are_counted(spark, tmp_path):
    head = ",".join(schemas.PRODUCTS.names)
    path = csv(tmp_path, f"{head}\na,40.0,287.5,NA,,x,1e2, 7 ,c\n")
    assert rows(tables.read_csv_table(spark, path, "products")) == [("a", 40.0, 287.5, None, None, None, 100.0, 7.0, "c")]
    found = dict(rows(tables.csv_rejects(spark, path, schemas.PRODUCTS, True)))
    assert {k for k, n in found.items() if n} == {"product_length_cm"} and found["product_length_cm"] == 1
    path = csv(tmp_path, "order_id,payment_sequential,payment_type,payment_installments,payment_value\no,2.0,t,2.5,NA\n")
    assert rows(tables.read_csv_table(spark, path, "order_payments")) == [("o", 2, "t", None, None)]
    assert dict(rows(tables.csv_rejects(spark, path, schemas.ORDER_PAYMENTS))) == {
        "payment_sequential": 0, "payment_installments": 1, "payment_value": 0,
    }


def test_inference_is_an_option(spark, tmp_path):
    path = str(tmp_path / "items.csv")
    (tmp_path / "items.csv").write_text("order_id,order_item_id,product_id,price,shipping_cost\n1,2,x,3.5,\n")
    assert tables.read_csv_table(spark, path, "order_items").schema == schemas.ORDER_ITEMS
    inferred = tables.read_csv_table(spark, path, "order_items", infer=True)
    assert dict(inferred.dtypes)["order_id"] == "int"
    assert rows(inferred) == [(1, 2, "x", 3.5, None)]


def test_all_tables_of_a_folder(spark, tmp_path):
    review = ("r", "o", 5, ts("2021-01-01"), "NA")
    data = {
        "order_reviews": [review],
        "order_items": [("o", 1, "p1", 1.0, 2.0)],
        "products": [PRODUCT],
        "orders": [("o", "delivered", "2021-01-01 00:00:00", "NA", "NA", "NA", "NA")],
        "order_payments": [("o", 1, "card", 1, 3.0)],
    }
    for name, values in data.items():
        df = spark.createDataFrame(values, schemas.BY_TABLE[name])
        tables.write_csv(df, f"{tmp_path}/test_{name}.csv", name in schemas.DOUBLED_QUOTES)
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    from_csv = tables.read_csv_tables(spark, str(tmp_path), "test_")
    from_parquet = tables.read_parquet_tables(spark, str(tmp_path))
    for name, values in data.items():
        assert rows(getattr(from_csv, name)) == rows(getattr(from_parquet, name)) == values
    assert tables.read_csv_tables(spark, str(tmp_path), "test_", reviews=False).order_reviews is None


def test_scores_are_written(spark, tmp_path):
    scores = spark.createDataFrame([("o", 1.0, "extra")], "order_id string, prediction double, more string")
    tables.write_scores(scores, str(tmp_path / "scores"))
    assert rows(spark.read.parquet(str(tmp_path / "scores"))) == [("o", 1.0)]


def test_checkpoint_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert session.shared_dir(spark) == named
    assert session.shared_path(spark, "x") != session.shared_path(spark, "x")
    kept = session.cut_lineage(spark.range(3))
    assert rows(kept) == [(0,), (1,), (2,)]
