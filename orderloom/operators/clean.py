"""Row filters, type repair, null handling and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from orderloom.sources.schemas import NA_TOKEN

# Fixed value: stands for a missing day count in a model table.
MISSING_DAYS = 99999
DAY_COUNTS = ("estimated_delivery_days", "order_to_approval_days", "actual_delivered_days")


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


def as_time(df: DataFrame, column: str) -> Column:
    """A column as timestamp: text that does not parse becomes null, times pass through.

    Zone-free timestamps keep hours and dates independent of the cluster's zone.
    """
    value = F.col(column)
    return value.try_cast("timestamp_ntz") if _is_text(df, column) else value


def cast_times(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Keep all columns, add each raw time under its new name, drop the raw ones."""
    casts = [as_time(df, raw).alias(new) for raw, new in names.items()]
    return df.select("*", *casts).drop(*names)


def in_time_range(df: DataFrame, column: str, first: str, last: str) -> DataFrame:
    """Rows whose time lies in [first, last]; both bounds belong to the range."""
    bounds = [F.lit(bound).cast("timestamp_ntz") for bound in (first, last)]
    return df.where(F.col(column).between(*bounds))


def drop_na_keys(df: DataFrame, key: str = "order_id", token: str = NA_TOKEN) -> DataFrame:
    """Remove rows whose key is null or is the text that stands for a missing key."""
    value = F.nullif(F.col(key), F.lit(token)) if _is_text(df, key) else F.col(key)
    return df.where(value.isNotNull())


def dedupe(df: DataFrame) -> DataFrame:
    """One copy of each whole row; copies are combined before the shuffle."""
    return df.dropDuplicates()


def to_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in columns})


def nonpositive_rows(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows in which every one of the columns is zero or negative."""
    condition = F.lit(True)
    for name in columns:
        condition = condition & (F.col(name) <= 0)
    return df.where(condition)


def rows_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def rows_having(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def fill_missing_days(df: DataFrame, columns: Iterable[str] = DAY_COUNTS) -> DataFrame:
    return df.na.fill(MISSING_DAYS, subset=list(columns))


def quoted(name: str) -> str:
    """A column name as it must be written in an expression."""
    return "`" + name.replace("`", "``") + "`"


def all_present(df: DataFrame) -> DataFrame:
    """Rows without nulls, as one predicate per column.

    The optimizer drops the predicate of a column that cannot be null, so unlike
    ``dropna`` this keeps unused columns prunable, and pushes the others to the scan.
    """
    return df.where(" AND ".join(f"{quoted(name)} IS NOT NULL" for name in df.columns))


def drop_incomplete(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a null in any column, or in any column of the subset."""
    return df.dropna(how="any", subset=None if subset is None else list(subset))
