"""Frequency index of a column with any number of values, kept as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.operators.clean import quoted
from orderloom.operators.ranks import numbered
from orderloom.session import cut_lineage

#: The most frequent values whose index is broadcast. The next one holds at most as small a
#: share of all rows as one over this number, so the shuffle that indexes the rest is even.
HEAD = 1000


def value_index(df: DataFrame, column: str) -> DataFrame:
    """(value, n, index) of all values of a column as text: 0 is the most frequent, ties go in text order.

    Values are counted, range-sorted by count and text, and numbered by prefix sums over
    the ranges. No list of values comes to the driver, and no task sorts all of them.
    Nulls have no index. The result is a table in the shared folder.
    """
    text = F.col(quoted(column)).cast("string")
    counted = df.select(text.alias("value")).where("value IS NOT NULL").groupBy("value").agg(F.count("*").alias("n"))
    return cut_lineage(numbered(counted, [F.desc("n"), F.asc("value")], "index"))


def with_index(df: DataFrame, index: DataFrame, column: str, name: str, unseen: str = "error", head: int = HEAD) -> DataFrame:
    """``df`` with the index of a column's value as a double, as a string indexer gives it.

    Null and unseen values raise an error, or get the next free index with
    ``unseen="keep"``. Rows of the ``head`` most frequent values meet a broadcast of them;
    the others are joined in a shuffle, rows without a value not at all.
    """
    text = F.col(quoted(column)).cast("string")
    own = df.select(F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row"), text.alias("value"))
    places = index.select("value", "index")
    first = F.broadcast(places.where(F.col("index") < head))
    known = own.where("value IS NOT NULL")
    frequent = known.join(first, "value")
    rest = known.join(first.select("value"), "value", "left_anti").join(places.where(F.col("index") >= head), "value", "left")
    without = own.where("value IS NULL").withColumn("index", F.lit(None).cast("bigint"))
    met = frequent.unionByName(rest).unionByName(without)
    return met.select("row.*", _place(F.col("index"), index, unseen).alias(name))


def _place(found: Column, index: DataFrame, unseen: str) -> Column:
    if unseen == "keep":
        return F.coalesce(found, F.lit(index.count())).cast("double")
    if unseen == "error":
        return F.coalesce(found.cast("double"), F.raise_error(F.lit("a value that the index does not have")).cast("double"))
    raise ValueError(f"unseen is 'error' or 'keep', not {unseen!r}")
