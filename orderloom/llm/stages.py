"""Stage tables in the shared folder, and joins that stay even under hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.session import shared_path

#: A key is hot from this share of all rows on, so there are at most as many hot keys
#: as its inverse, whatever the size of the input.
HOT_SHARE = 0.001
#: Bits of the filter that ``likely`` broadcasts: 8 MB in 2,048 rows.
FILTER_BITS = 1 << 26


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared storage and read it again.

    Cuts the lineage: what comes after it reads files that every executor can reach.
    """
    path = shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a stage table that nothing reads any more."""
    spark = df.sparkSession
    for name in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def attach(rows: DataFrame, groups: DataFrame, key: str | list[str], size: str) -> DataFrame:
    """``rows`` with the columns of their key's row in ``groups`` (inner join).

    ``groups`` has one row per key and the number of rows of that key in ``size``. Keys
    with a thousandth of all rows or more (at most 1,000 of them) are joined to a
    broadcast of their group rows, so that their rows are never shuffled to one task; all
    other rows meet their group in a shuffled join. Both inputs are read twice and should
    be stage tables. Null keys match nothing.
    """
    key = [key] if isinstance(key, str) else key
    total = groups.agg(F.sum(size)).first()[0] or 0
    hot = F.broadcast(groups.where(F.col(size) > total * HOT_SHARE))
    even = rows.join(hot.select(*key), key, "left_anti")
    cold = groups.where(F.col(size) <= total * HOT_SHARE)
    return rows.join(hot, key).unionByName(even.join(cold, key))


def likely(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in ``wanted``.

    A filter of fixed size, for rows too wide to shuffle when few are wanted: one bit per
    hash of a wanted key, in bitmaps that are broadcast. Rows of wanted keys always pass;
    others pass by chance, more of them the fuller the bitmaps are, so a join has to follow.
    """
    bit = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS))
    own = wanted.select(bit.alias("bit")).groupBy(F.bitmap_bucket_number("bit").alias("filter_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("filter_bits")
    )
    place = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring("filter_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    # The shift is by a column, which the function for constant shifts does not take.
    there = F.floor(byte / F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (place % 8 + 1).cast("int"))) % 2 == 1
    met = rows.withColumn("filter_own", F.bitmap_bucket_number(bit)).join(F.broadcast(own), F.col("filter_own") == F.col("filter_map"))
    return met.where(there).select(*rows.columns)
