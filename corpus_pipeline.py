"""From raw documents to packed training sequences.

Five stages, each over all its predecessor kept: language ID (documents
without a language go), line dedup (lines that many documents share go),
MinHash near-dedup on shingles of five words (one document of each group
stays), benchmark decontamination (documents holding an item go) and best-fit
packing. All but the last return the columns of ``documents``.

Defined cases: a document emptied by line dedup stays, with an empty text;
of rows repeated under one id with one text one stays after near-dedup; rows
with a null id are cleaned and packed, but never near-duplicates of others;
a table without rows passes through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthend.llm import decontam, langid, linededup, minhash, packing
from monthend.session import scratch_path

BPE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = {"text": F.col("kept"), "n_chars": F.length("kept").cast("long")}
    return linededup.dedup_lines(docs).select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(docs, shingle_words=5, percent=80)
    copies = found.where(~F.col("kept")).select("doc_id").distinct()
    print_col = "_".join(["print", *docs.columns])  # longer than any name there is
    left = docs.join(copies, "doc_id", "left_anti").withColumn(print_col, F.xxhash64("text"))
    return left.dropDuplicates(["doc_id", print_col]).drop(print_col)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), short=True)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, BPE_RANKS)


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Language ID, near-dedup and packing are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences that the stages make of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
