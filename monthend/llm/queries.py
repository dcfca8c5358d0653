"""Registered queries of the package: ``opN_<name>`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.llm import (
    chat,
    decontam,
    embedding,
    langid,
    linededup,
    merkle,
    minhash,
    packing,
    pii,
    spelling,
    substring,
    tokencount,
    warc,
)

BPE_JSON = public_tokenizers.path("byte_bpe_50k.json")
BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = turns.unionByName(chat.probe(spark, turns))
    return chat.read_back(chat.format_chat(said, BPE_RANKS), BPE_RANKS)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(table(spark, sf_dir, "documents"), BPE_JSON)


def op3_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BPE_RANKS)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), short=True)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tampered_manifest(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op13_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_chat_format,
    op2_token_counts,
    op3_minhash_forest,
    op4_substring_dedup,
    op5_embedding_dedup,
    op6_best_fit_packing,
    op7_decontamination,
    op8_personal_data,
    op9_language_id,
    op10_line_dedup,
    op11_merkle_manifest,
    op12_spelling_variants,
    op13_warc_round_trip,
)}

ORACLES = {
    "op10_line_dedup": linededup.SQL,
    "op11_merkle_manifest": merkle.SQL,
    "op12_spelling_variants": spelling.SQL,
    "op13_warc_round_trip": warc.SQL,
}
