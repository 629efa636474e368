"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, folder of the tables) and returns a DataFrame; what it
returns is written as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import exact, langid, mixing, packing, simhash
from orderloom.llm.queries import tokenizer_path
from orderloom.llm.stages import stage

#: Each stage carries a document's columns in one struct, so that none of them can meet a
#: column that an operator adds.
ROW = "row"

#: Documents less like every language than this are rejected.
LEAST_SCORE = 0.02


def _carried(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(ROW), *columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a learned language; null texts and texts without a letter go."""
    guessed = langid.predict(_carried(docs, "text"), langid.fit(docs.select("doc_id", "text", "lang")))
    return guessed.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(f"{ROW}.*")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts: the longest original, then the smallest id."""
    found = exact.exact_duplicates(docs.select("doc_id", "text"))
    stays = found.where("kept").select(F.col("doc_id").alias("kept_id"), F.col("text_sha256").alias("kept_text")).distinct()
    keyed = _carried(docs, F.col("doc_id").alias("own_id"), F.sha2(exact.normalised(F.col("text")), 256).alias("own_text"))
    same = keyed["own_id"].eqNullSafe(stays["kept_id"]) & (keyed["own_text"] == stays["kept_text"])
    return keyed.join(stays, same, "left_semi").dropDuplicates(["own_id", "own_text"]).select(f"{ROW}.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-duplicates: that with the smallest id.

    A group without any id keeps one of its texts, too.
    """
    marked = stage(_carried(docs, F.col("doc_id").alias("own_id"), simhash.fingerprint_column(F.col("text")).alias("own_fp")), "simhash")
    found = simhash.near_duplicates(marked, "own_id", "own_fp")
    stays = found.where(F.col("own_id").eqNullSafe(F.col("component_id")) & (F.col("fp") == F.col("keeper_fp"))).select(
        F.col("own_id").alias("kept_id"), F.col("fp").alias("kept_fp")
    ).distinct()
    same = marked["own_id"].eqNullSafe(stays["kept_id"]) & (marked["own_fp"] == stays["kept_fp"])
    return marked.join(stays, same, "left_semi").dropDuplicates(["own_id", "own_fp"]).select(f"{ROW}.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it, none more than three times."""
    return mixing.repeated(mixing.mix(_carried(docs, "doc_id", "text", "source"))).select(f"{ROW}.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 4,096 tokens."""
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Fingerprints, learned profiles and token ids are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
