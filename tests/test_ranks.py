from __future__ import annotations

from pyspark.sql import functions as F

from orderloom.operators.ranks import numbered


def test_places_in_one_order(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 1000).alias("v"), F.lit("x").alias("n"))
    got = numbered(df, [F.desc("v")], "place").collect()
    assert sorted(r["place"] for r in got) == list(range(5000))
    ordered = [r["v"] for r in sorted(got, key=lambda r: r["place"])]
    assert ordered == sorted(ordered, reverse=True) and all(r["n"] == "x" for r in got)


def test_places_within_groups(spark):
    rows = [(None if i % 4 == 0 else f"g{i % 4}", i * 13 % 50) for i in range(400)] + [("one", 1)]
    got = numbered(spark.createDataFrame(rows, "g string, v int"), [F.asc("v")], "place", within="g", group="no", total="all").collect()
    assert len(got) == 401
    names = sorted({r["g"] for r in got}, key=lambda g: (g is not None, g or ""))
    for no, g in enumerate(names):
        own = sorted((r for r in got if r["g"] == g), key=lambda r: r["place"])
        assert [r["place"] for r in own] == list(range(len(own)))
        assert [r["v"] for r in own] == sorted(r["v"] for r in own)
        assert {(r["no"], r["all"]) for r in own} == {(no, len(own))}


def test_equal_rows_and_empty_tables(spark):
    same = spark.range(0, 1000, 1, 4).select(F.lit(1).alias("v"))
    assert sorted(r["place"] for r in numbered(same, [F.asc("v")], "place").collect()) == list(range(1000))
    none = spark.createDataFrame([], "g string, v int")
    assert numbered(none, [F.asc("v")], "place", within="g", group="no").collect() == []
