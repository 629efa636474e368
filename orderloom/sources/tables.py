"""Readers and writers for the input tables and the scored output."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from orderloom.sources import schemas


@dataclass(frozen=True)
class OrderTables:
    """The inputs of one run. Holdout runs have no reviews.

    ``tasks`` is set where items are a shared table (see ``with_shared_items``): they hold no
    copies then, and so many tasks gather items and payments by order.
    """

    orders: DataFrame
    order_items: DataFrame
    products: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame | None = None
    tasks: int | None = None


def _reader(spark: SparkSession, doubled_quotes: bool):
    reader = spark.read.option("header", True)
    return reader.option("escape", '"') if doubled_quotes else reader


def _text(spark: SparkSession, path: str, schema: T.StructType, doubled_quotes: bool) -> DataFrame:
    """The schema's columns as text, taken by the names in the header."""
    text = _reader(spark, doubled_quotes).csv(path)
    missing = [name for name in schema.names if name not in text.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return text.select(*schema.names)


def _value(field: T.StructField) -> Column:
    """A text field as the value of its column; null where it is none."""
    text = F.col(field.name)
    if field.name in schemas.PRODUCT_MEASURES:
        return text.try_cast("double")
    if not isinstance(field.dataType, T.IntegerType):
        return text.try_cast(field.dataType)
    number = text.try_cast("double")
    return F.when(number == F.floor(number), number).try_cast("int")


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str | None = None,
    doubled_quotes: bool = False,
) -> DataFrame:
    """Read CSV with a header row.

    With a schema, its columns are found by name, in any order; columns it does not
    name are left out, and a missing one is an error. Product measures become doubles,
    so ``287.5`` keeps its value; elsewhere ``40.0`` is the whole number 40. ``NA`` and text
    that is no value of the column become null; ``csv_rejects`` counts the latter. Without a schema the
    types are inferred, which reads the data once more. ``doubled_quotes`` reads ``""``
    inside a quoted field as one quote sign. A field must not contain a line break.
    """
    if schema is None:
        return _reader(spark, doubled_quotes).option("inferSchema", True).csv(path)
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = _text(spark, path, schema, doubled_quotes)
    return text.select(*[
        (F.col(f.name) if isinstance(f.dataType, T.StringType) else _value(f)).alias(f.name)
        for f in schema.fields
    ])


def csv_rejects(spark: SparkSession, path: str, schema: T.StructType, doubled_quotes: bool = False) -> DataFrame:
    """(column_name, rejected): how many fields hold text that is no value of their column.

    Empty fields and ``NA`` are missing values, not rejects. One pass over the file.
    """
    typed = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    text = _text(spark, path, schema, doubled_quotes)
    counts = text.agg(*[
        F.count_if(
            (F.trim(f.name) != schemas.NA_TOKEN) & (F.trim(f.name) != "") & _value(f).isNull()
        ).alias(f.name)
        for f in typed
    ])
    return counts.unpivot([], [f.name for f in typed], "column_name", "rejected")


def read_csv_table(spark: SparkSession, path: str, table: str, infer: bool = False) -> DataFrame:
    """Read one of the five tables by name with its own schema and quoting."""
    return read_csv(
        spark,
        path,
        schema=None if infer else schemas.BY_TABLE[table],
        doubled_quotes=table in schemas.DOUBLED_QUOTES,
    )


def read_csv_tables(
    spark: SparkSession, folder: str, prefix: str = "", reviews: bool = True, infer: bool = False
) -> OrderTables:
    """Read ``{folder}/{prefix}{table}.csv`` for all tables of a run."""
    names = [name for name in schemas.BY_TABLE if reviews or name != "order_reviews"]
    return OrderTables(**{
        name: read_csv_table(spark, f"{folder}/{prefix}{name}.csv", name, infer) for name in names
    })


def read_parquet_tables(
    spark: SparkSession, folder: str, prefix: str = "", reviews: bool = True
) -> OrderTables:
    """Read ``{folder}/{prefix}{table}.parquet`` for all tables of a run."""
    names = [name for name in schemas.BY_TABLE if reviews or name != "order_reviews"]
    return OrderTables(**{
        name: spark.read.parquet(f"{folder}/{prefix}{name}.parquet") for name in names
    })


def write_csv(df: DataFrame, path: str, doubled_quotes: bool = False) -> None:
    writer = df.write.option("header", True)
    if doubled_quotes:
        writer = writer.option("escape", '"')
    writer.csv(path)


def write_scores(scores: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write (order_id, prediction) as Parquet, one file per task."""
    scores.select("order_id", "prediction").write.mode(mode).parquet(path)
