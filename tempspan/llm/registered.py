"""The registered queries of this folder, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.llm.byte_bpe import encode_and_decode
from tempspan.llm.decontamination import decontaminate
from tempspan.llm.html_text import with_main_text
from tempspan.llm.jaccard_join import jaccard_join
from tempspan.llm.language_id import identify_languages
from tempspan.llm.license_scan import oracle_sql as license_sql, scan_licenses
from tempspan.llm.merkle_manifest import audited, oracle_sql as manifest_sql
from tempspan.llm.quality_rules import apply_quality_rules, oracle_sql as quality_sql
from tempspan.llm.sharding import shard_documents
from tempspan.llm.source_divergence import oracle_sql as divergence_sql, source_divergence
from tempspan.llm.tables import read_table
from tempspan.llm.token_counts import with_token_counts
from tempspan.llm.token_files import read_token_files, store_tokens
from tempspan.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_quality_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_lines_removed",
    )


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_main_text(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(documents, read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "contaminated", "n_regions", "item_ids"
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify_languages(documents).select("doc_id", "held_out", "lang_pred", "score")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return with_token_counts(documents, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_bytes", "n_tokens", "over_limit"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    folder = store_tokens(documents, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, folder, with_ids=False)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_and_decode(documents, path, public_tokenizers.PATTERN).select(
        "doc_id", "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(read_table(spark, sf_dir, "documents"))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(read_table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score_toxicity(documents, read_table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", "predicted"
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_html_text": op2_html_text,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_license_scan": op4_license_scan,
    "op5_decontamination": op5_decontamination,
    "op6_language_id": op6_language_id,
    "op7_token_counts": op7_token_counts,
    "op8_token_files": op8_token_files,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_sharding": op10_sharding,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_toxicity": op12_toxicity,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": quality_sql(),
    "op4_license_scan": license_sql(),
    "op11_merkle_manifest": manifest_sql(),
    "op13_source_divergence": divergence_sql(),
}
