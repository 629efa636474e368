"""Training and test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

TRAIN_SHARE = 0.7
SEED = 123
BUCKETS = 10_000


def split_bucket(key: Column, seed: int = SEED) -> Column:
    """A number below BUCKETS that depends on key and seed alone."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS).cast("int")


def split_by_key(
    df: DataFrame, key: str = "order_id", share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by hash of the key.

    The same key lands on the same side whatever the partitioning, after any retry,
    and all rows of a key stay together. No shuffle.
    """
    in_train = split_bucket(F.col(key), seed) < int(share * BUCKETS)
    return df.where(in_train), df.where(~in_train)


def split_at_random(
    df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by row sampling. Depends on partitioning: cut the lineage first."""
    train, test = df.randomSplit([share, 1 - share], seed=seed)
    return train, test
