from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import DataFrame, functions as F

from orderloom.ml import encode, index


def test_equals_the_string_indexer(spark):
    df = spark.createDataFrame([("b", 1), ("b", 2), ("a", 3), ("a", 4), ("c", 5), ("c", 6), ("c", 7), ("d", 8), ("é", 9), ("Z", 10)], "payment_type string, n int")
    fitted = encode.encoder({"payment_type": "payment_type"}).getStages()[0].fit(df)
    want = fitted.transform(df).select("n", "payment_type_Ind")
    got = index.with_index(df, index.value_index(df, "payment_type"), "payment_type", "payment_type_Ind")
    assert rows(got, "n", "payment_type_Ind") == rows(want)


@pytest.mark.parametrize("head", [0, 1, 1000])
def test_unseen_null_and_clashing_columns(spark, head):
    df = spark.createDataFrame([("x", 1), ("x", 2), ("y", 3)], "value string, row int")
    table = index.value_index(df, "value")
    later = spark.createDataFrame([("y", 1), ("new", 2), (None, 3), ("x", 4), ("x", 4)], "value string, row int").withColumn("index", F.lit("own"))
    got = index.with_index(later, table, "value", "place", unseen="keep", head=head)
    assert got.columns == ["value", "row", "index", "place"]
    assert rows(got, "row", "place") == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 0.0), (4, 0.0)] and {r["index"] for r in got.collect()} == {"own"}
    with pytest.raises(Exception, match="a value that the index does not have"):
        index.with_index(later, table, "value", "place", head=head).collect()
    with pytest.raises(ValueError):
        index.with_index(later, table, "value", "place", unseen="drop")


def test_a_million_values_without_a_list_on_the_driver(spark, monkeypatch):
    n = 1_000_000
    df = spark.range(0, n, 1, 8).select(F.lpad(((F.col("id") * 7919) % n).cast("string"), 7, "0").alias("v"))
    for name in ("collect", "toPandas", "toLocalIterator", "take", "head"):
        monkeypatch.setattr(DataFrame, name, lambda *a, **k: pytest.fail("rows come to the driver"))
    table = index.value_index(df, "v")
    out = index.with_index(df, table, "v", "i")
    wrong = out.where(F.col("v").cast("int") != F.col("i").cast("int"))  # equal counts: text order
    assert table.count() == n and out.count() == n and wrong.count() == 0


def test_empty_table(spark):
    none = spark.createDataFrame([], "v string")
    table = index.value_index(none, "v")
    assert table.count() == 0 and index.with_index(none, table, "v", "i").collect() == []
