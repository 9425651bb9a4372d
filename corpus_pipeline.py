"""From raw documents to token ids: quality rules, near-duplicates, repeated passages, benchmark leaks, byte-level BPE.

Each stage takes (spark, docs, sf_dir), works on all that the one before it
kept, and hands on the columns of its input; the last returns the ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.llm import byte_bpe, decontaminate, quality, simhash, substrings
from lodestay.llm.common import stored, uncarried

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

#: XXH64, near-duplicate groups and byte-pair merges have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep, without their failing lines."""
    judged = quality.quality_rules(docs, carry=True).where("kept")
    return uncarried(judged, docs, "clean_text")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest doc_id.

    Rows with one doc_id stay or go together; a row without one stays, as no
    other can stand for it.
    """
    groups = simhash.near_duplicates(docs)
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; what lost nothing keeps its text to the letter.

    A document of which no word is left goes.
    """
    kept = substrings.without_repeated_passages(docs)
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item contaminates, without the few words that still occur in an item's window of 13 words."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    judged = decontaminate.decontaminate(docs, items, carry=True, unnamed=True).where("not contaminated")
    return uncarried(judged, docs, "clean_text")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang and source, the ids, and the digests of ids and of what they decode to."""
    encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, carry=True)
    return encoded.select(
        "doc_id", F.col("row.lang").alias("lang"), F.col("row.source").alias("source"), "n_tokens", "ids",
        "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("repeated_passages", passage_stage),
    ("decontamination", decontamination_stage),
    ("byte_bpe", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
