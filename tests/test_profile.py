from __future__ import annotations

from conftest import rows
from pyspark.sql import functions as F

from orderloom.operators import profile
from orderloom.session import cut_lineage


def table(spark):
    data = [("a", 1, 2.0), ("a", 1, 2.0), ("a", None, 4.0), (None, 3, None), ("b", 3, 6.0)]
    return spark.createDataFrame(data, "k string, n int, x double")


def test_null_counts(spark):
    assert rows(profile.null_counts(table(spark))) == [("k", 1), ("n", 1), ("x", 1)]


def test_null_counts_of_no_rows(spark):
    assert rows(profile.null_counts(table(spark).limit(0))) == [("k", 0), ("n", 0), ("x", 0)]


def test_distinct_counts(spark):
    assert rows(profile.distinct_counts(table(spark), "k")) == [(5, 4, 3)]
    assert rows(profile.distinct_counts(table(spark).limit(0), "k")) == [(0, 0, 0)]
    whole = table(spark).withColumn("part", F.lit(1))
    assert rows(profile.approx_distinct_keys(profile.key_sketches(whole, "k", "part"))) == [(2,)]


def test_merged_sketches_equal_one_pass(spark):
    df = spark.range(0, 200_000, 1, 8).select((F.col("id") % 50_000).alias("k"), (F.col("id") * 7 % 31).alias("day"))
    stored = cut_lineage(profile.key_sketches(df, "k", "day"))
    merged = profile.approx_distinct_keys(stored).first()[0]
    assert merged == profile.approx_distinct_keys(profile.key_sketches(df.withColumn("day", F.lit(0)), "k", "day")).first()[0]
    assert abs(merged - 50_000) < 1_500
    assert stored.agg(F.max(F.octet_length("sketch"))).first()[0] < 1 << 16


def test_distinct_values(spark):
    assert rows(profile.distinct_values(table(spark), ["k", "n"])) == [
        ("k", "a"), ("k", "b"), ("k", None), ("n", "1"), ("n", "3"), ("n", None),
    ]


def test_describe(spark):
    n, x = sorted(map(tuple, profile.describe(table(spark), ["n", "x"]).collect()))
    assert n[:3] == ("n", 4, 2.0) and n[4:] == (1.0, 3.0) and abs(n[3] - (4 / 3) ** 0.5) < 1e-12
    assert x[:3] == ("x", 4, 3.5) and x[4:] == (2.0, 6.0)


def test_counts_and_checks(spark):
    df = table(spark)
    assert rows(profile.row_counts({"one": df, "none": df.limit(0)})) == [("none", 0), ("one", 5)]
    assert rows(profile.duplicate_keys(df, "k")) == [("a", 3)]
    assert rows(profile.group_counts(df, "k", "n", "c")) == [("a", 2), ("b", 1), (None, 1)]
    checks = profile.count_checks(df, {"equal": F.col("n") == F.col("x"), "any": F.col("n") > 0})
    assert rows(checks) == [("any", 4), ("equal", 0)]


def test_describe_text(spark):
    assert rows(profile.describe_text(table(spark), ["k"])) == [("k", 4, "a", "b")]
