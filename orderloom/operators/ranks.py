"""Places of rows in a global order, without a list on the driver or one task that sorts all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderloom.session import cut_lineage

_TIE, _RANGE, _AT, _GROUP, _START = "_place_tie", "_place_range", "_place_at", "_place_group", "_place_start"


def numbered(
    df: DataFrame,
    order: Sequence[Column],
    name: str,
    within: str | None = None,
    group: str | None = None,
    total: str | None = None,
) -> DataFrame:
    """``df`` with ``name``: each row's place in ``order``, from 0, without gaps.

    With ``within`` the places are counted for each value of that column (null is a
    value); ``group`` is then the place of that value among all values, nulls first, and
    ``total`` the number of its rows.

    Rows are range-sorted into a table that keeps the number of each row's range. Sums of
    the ranges' row counts give what stands before a range, and only inside a range are
    rows counted one by one. Equal rows are told apart by where they were read, so a
    value that all rows share is spread over ranges as well. Columns of ``df`` must not
    start with ``_place_``.
    """
    by = [within] if within else []
    first = [F.asc_nulls_first(within)] if within else []
    keys = [*first, *order, F.col(_TIE)]
    placed = cut_lineage(
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(_RANGE, F.spark_partition_id())
    )
    sizes = placed.groupBy(*by, _RANGE).agg(F.count("*").alias("n"))
    # Without ``within`` this window has one row for each range.
    before = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        *[F.col(c).alias(_GROUP) for c in by], F.col(_RANGE).alias(_AT),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias(_START),
        *([F.sum("n").over(Window.partitionBy(*by)).alias(total)] if total else []),
    )
    if group:
        values = numbered(placed.select(F.col(within).alias("value")).distinct(), [F.asc_nulls_first("value")], group)
        starts = starts.join(values, F.col(_GROUP).eqNullSafe(F.col("value"))).drop("value")
    inside = Window.partitionBy(*by, _RANGE).orderBy(*order, _TIE)
    rows = placed.withColumn(name, F.row_number().over(inside) - 1)
    same = F.col(_RANGE) == F.col(_AT)
    if within:
        same = same & F.col(within).eqNullSafe(F.col(_GROUP))
    extra = [c for c in (group, total) if c]
    return rows.join(starts, same).select(*df.columns, (F.col(name) + F.col(_START)).cast("bigint").alias(name), *extra)
