"""From raw documents to token ids: five stages, each on what its predecessor kept.

Every stage reads the written table of the one before and returns the columns of
``documents``; the last one returns the encoded corpus. The stages that draw on a trained
model or on near-duplicate classes have no SQL form, so ``ORACLE_SQL`` is None and the tests
hold each stage against a plain version.

Defined results, for every stage: a null text counts as empty, has no language and goes with the
first stage; so do empty texts and those without a letter. Very long texts are worked on whole.
Rows are documents by themselves: rows that share an id, or have none, are judged one by one
by their texts, and no stage drops one for another's sake, except that of near duplicates, which keeps
one row of each class, that of the smallest id, rows without an id last, and of rows with one
id the first that is read. Equal scores get equal verdicts. An empty
table stays empty through all stages. Other columns than those of ``documents`` are dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempspan.llm.byte_bpe import encode_and_decode
from tempspan.llm.decontamination import decontaminate
from tempspan.llm.jaccard_join import jaccard_join
from tempspan.llm.language_id import UNDETERMINED, identify_languages
from tempspan.llm.quality_rules import apply_quality_rules
from tempspan.llm.tables import read_table
from tempspan.runtime import fresh_folder, write_shared

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_SCORE = 0.5
BROADCAST_BYTES = 32 << 20


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents whose language is determined with at least ``LEAST_SCORE``."""
    known = identify_languages(docs.select(*COLUMNS))
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= LEAST_SCORE)
    return known.where(sure).select(*COLUMNS)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that pass, without the lines that failed."""
    judged = apply_quality_rules(docs.select(*COLUMNS)).where("kept")
    cleaned = judged.withColumn("text", F.col("clean_text"))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each class of near duplicates, that of the smallest id."""
    # Ids may repeat or be missing, so rows are known by numbers of their own.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), *COLUMNS)
    numbered = write_shared(numbered, "numbered")
    linked = jaccard_join(numbered.select("row", "text"), key="row").where("n_links > 0")
    linked = linked.join(numbered.select("row", "doc_id"), "row").select("row", "class_id", "doc_id")
    linked = write_shared(linked, "linked")
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = linked.groupBy("class_id").agg(F.min(rank).alias("first")).select("first.row")
    gone = write_shared(linked.select("row").join(first, "row", "left_anti"), "gone")
    if 16 * gone.count() <= BROADCAST_BYTES:
        gone = F.broadcast(gone)
    return numbered.join(gone, "row", "left_anti").select(*COLUMNS)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which no benchmark passage is found."""
    found = decontaminate(docs.select(*COLUMNS), read_table(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select(*COLUMNS)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoded corpus: ids as little-endian unsigned 32-bit integers, with digests."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_and_decode(docs.select(*COLUMNS), path, public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "lang", "source", "n_tokens", "token_ids",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("language ID", language_id),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE", byte_bpe),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the table is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            path = fresh_folder(spark, f"stage-{number}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
