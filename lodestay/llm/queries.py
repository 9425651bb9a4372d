"""Registered queries of the operators: each over its whole table, with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestay.llm import (
    byte_bpe, decontaminate, html_text, language, prefix_trie, quality, simhash, sql, substrings, token_counts,
    token_files, url_filter, vector_codes, warc,
)
from lodestay.llm.common import stored

BYTE_BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")

URL_RULES = (
    url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"), url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register
def op2_byte_bpe(spark, sf_dir):
    return byte_bpe.encode_documents(
        table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN, digests_only=True)


@register
def op3_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECES)


@register
def op4_token_files(spark, sf_dir):
    return token_files.round_trip(table(spark, sf_dir, "documents"), WORD_BPE, end_id=1)


@register
def op5_quality_rules(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@register
def op7_url_filter(spark, sf_dir):
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES, default="allow")


@register
def op8_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language.fit(docs.where(~held_out & F.col("doc_id").isNotNull()))
    return language.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register
def op9_decontaminate(spark, sf_dir):
    return decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), unnamed=True).drop("clean_text")


@register
def op10_main_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_text.extract_text(pages, html_text.learn_weights(pages))


@register
def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op1_repeated_passages(spark, sf_dir):
    return substrings.repeated_passages(table(spark, sf_dir, "documents")).drop("kept_text", "text_hash")


@register
def op11_prefix_trie(spark, sf_dir):
    turns = stored(prefix_trie.turns_of(table(spark, sf_dir, "conversations")), "turns")
    return prefix_trie.prefix_trie(prefix_trie.rebuilt_paths(turns)).drop("key", "parent_key")


@register
def op12_warc(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


@register
def op13_vector_codes(spark, sf_dir):
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


ORACLES |= {
    "op1_repeated_passages": sql.PASSAGES,
    "op5_quality_rules": sql.quality(),
    "op7_url_filter": sql.url_rules(URL_RULES, "allow"),
    "op9_decontaminate": sql.CONTAMINATION,
    "op11_prefix_trie": sql.PREFIX_TRIE,
    "op12_warc": sql.ARCHIVE,
    "op13_vector_codes": sql.vector_codes(),
}
