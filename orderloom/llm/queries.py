"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.llm import alignment, chat, decontaminate, exact, langid, lines, merkle, mixing, packing, repetition, secrets, simhash, warc
from orderloom.llm.stages import stage
from orderloom.session import shared_path

TOKENIZER = "word_bpe_49k.json"


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("tokens")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op2_secrets(spark: SparkSession, sf: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf, "documents"))
    base = F.filter("found", lambda s: s["kind"].isin(*secrets.KINDS[:3]))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in secrets.KINDS[:3]],
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"),
    )


def op3_simhash(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", simhash.fingerprint_column(F.col("text")).alias("fp"))
    found = simhash.near_duplicates(stage(docs, "simhash"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")


def op4_exact(spark: SparkSession, sf: str) -> DataFrame:
    return exact.exact_duplicates(_table(spark, sf, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_warc(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write_archives(_table(spark, sf, "pages"), path)
    return warc.page_records(spark, path)


def op6_lines(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    gone = lines.duplicate_lines(docs).groupBy(F.col("doc_id").alias("gone_id")).agg(
        F.count("*").alias("n_gone"), F.array_sort(F.collect_list("line_no")).alias("gone")
    )
    all_lines = docs.select("doc_id", F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("bigint").alias("n_lines"))
    return all_lines.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left").select(
        "doc_id", "n_lines", F.coalesce("n_gone", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.coalesce(F.array_join("gone", ","), F.lit("")).alias("dropped_lines"),
    )


def op7_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents").select("doc_id", "text", "lang")
    guessed = langid.predict(docs.select("doc_id", "text"), langid.fit(docs))
    return guessed.select("doc_id", langid.held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op8_chat(spark: SparkSession, sf: str) -> DataFrame:
    rows = _table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    odd = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", odd), (-1, 1, "assistant", odd)], rows.schema)
    typed = rows.unionByName(extra).withColumn("parts", chat.text_parts(F.col("text")))
    return chat.read_back(chat.format_turns(typed))


def op9_mixing(spark: SparkSession, sf: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf, "documents"))
    taken = F.col("mix_passes") * F.col("mix_size") + F.col("mix_cut")
    return mixed.select(
        "doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"), taken.alias("taken"),
    )


def op10_repetition(spark: SparkSession, sf: str) -> DataFrame:
    found = repetition.repetition_rules(_table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fails"
    )


def op11_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.contamination(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_merkle(spark: SparkSession, sf: str) -> DataFrame:
    return merkle.document_manifest(_table(spark, sf, "documents"))


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.align_documents(_table(spark, sf, "documents"), *paths)


Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (op1_packing, op2_secrets, op3_simhash, op4_exact, op5_warc, op6_lines, op7_language, op8_chat, op9_mixing, op10_repetition,
              op11_decontamination, op12_merkle, op13_alignment)
}
