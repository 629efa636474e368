"""Table profiles: every profile of a table is one pass over it.

Profiles return long-form DataFrames (one row per column or check), so a result
never depends on how many columns a table has and nothing is printed or pulled to
the driver.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from orderloom.operators.clean import quoted
from orderloom.session import estimated_bytes


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for several tables in one result."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _to_long(one_row: DataFrame, name_column: str, value_column: str) -> DataFrame:
    return one_row.unpivot([], [F.col(quoted(name)) for name in one_row.columns], name_column, value_column)


def null_counts(df: DataFrame) -> DataFrame:
    """(column_name, null_count) for all columns."""
    row = df.agg(*[F.count_if(F.col(quoted(name)).isNull()).alias(name) for name in df.columns])
    return _to_long(row, "column_name", "null_count")


def count_checks(df: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """(check_name, row_count): rows meeting each condition, all counted together."""
    row = df.agg(*[F.count_if(condition).alias(name) for name, condition in checks.items()])
    return _to_long(row, "check_name", "row_count")


def distinct_counts(df: DataFrame, key: str) -> DataFrame:
    """One row: row_count, distinct_rows, distinct_keys (a null key counts as one).

    Two combining aggregations instead of several COUNT(DISTINCT), which would
    first multiply the rows by the number of counts.
    """
    per_row = df.groupBy(*df.columns).agg(F.count("*").alias("copies"))
    per_key = per_row.groupBy(key).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("variants")
    )
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("variants"), F.lit(0)).alias("distinct_rows"),
        F.count("*").alias("distinct_keys"),
    )


#: Sketches of 2^14 registers are within 3 % of the exact count in all but one case in 10,000.
SKETCH_BITS = 14


def key_sketches(df: DataFrame, key: str, by: str, bits: int = SKETCH_BITS) -> DataFrame:
    """(by, sketch): the keys of each part of a table, a day or a file, in a sketch of fixed size.

    Sketches are stored and merged, so new parts need no second look at the old ones.
    """
    return df.groupBy(by).agg(F.hll_sketch_agg(F.col(quoted(key)).cast("string"), bits).alias("sketch"))


def approx_distinct_keys(sketches: DataFrame) -> DataFrame:
    """One row: the estimated number of different keys behind all sketches."""
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_keys"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value): the distinct values of several columns as text."""
    as_text = df.select(*[F.col(name).cast("string").alias(name) for name in columns])
    return as_text.unpivot([], list(columns), "column_name", "value").distinct()


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, count, mean, stddev, min, max) with numeric results."""
    def summary(name: str) -> Column:
        value = F.col(name).cast("double")
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(value).alias("count"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    # one named struct per column, so that the aggregate holds plain values only
    row = df.agg(*[summary(name).alias(name) for name in columns])
    return row.select(F.inline(F.array(*[F.col(name) for name in columns])))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, count, min, max) of text columns, in text order."""
    def summary(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.count(name).alias("count"),
            F.min(name).alias("min"),
            F.max(name).alias("max"),
        )

    row = df.agg(*[summary(name).alias(name) for name in columns])
    return row.select(F.inline(F.array(*[F.col(name) for name in columns])))


def group_counts(df: DataFrame, key: str, counted: str, name: str) -> DataFrame:
    """Non-null values of ``counted`` per key."""
    return df.groupBy(key).agg(F.count(counted).alias(name))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(key).agg(F.count("*").alias("count")).where(F.col("count") > 1)


#: A table of fewer bytes fits a task as a whole, whatever its keys.
SAFE_BYTES = 1 << 30
#: A key is hot from this share of all rows on.
HOT_SHARE = 0.001
#: Keys that the sketch of ``has_hot_key`` follows; its error is far below the hot share.
TRACKED_KEYS = 50_000


def has_hot_key(df: DataFrame, key: str, safe_bytes: int = SAFE_BYTES) -> bool:
    """Whether one value of ``key`` holds a thousandth or more of a table too large for one task.

    One pass over the column, with a frequent-items sketch that is merged: nothing is
    shuffled by key. Tables that are small by Spark's own estimate are not read at all.
    """
    if estimated_bytes(df) < safe_bytes:
        return False
    n, top = most_frequent(df, key)
    return top > 0 and top >= HOT_SHARE * n


def most_frequent(df: DataFrame, key: str) -> tuple[int, int]:
    """Rows with a ``key``, and how many at most have the most frequent one; 0 if none stands out."""
    known = df.select(F.col(key).alias("key")).where("key IS NOT NULL")
    n, top = known.agg(F.count("*"), F.expr(f"approx_top_k(key, 1, {TRACKED_KEYS})")).first()
    return n, top[0]["count"] if top else 0
