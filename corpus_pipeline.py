"""Corpus pipeline: quality, line deduplication, near-duplicate documents, benchmark decontamination, token ids.

Each stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and returns them for what it keeps (the last
returns token ids); its result is written as Parquet and read again as the next stage's input.  Rows with the same id are
told apart by their text; null texts count as empty; empty tables pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainsift.llm import bpe, cotraining, decontaminate, jaccard, lines
from chainsift.llm.common import table, text_or_empty, working_tables, written

KEEP_FROM = 0.5
TOKENIZER = "word_bpe_49k.json"


def _with_text(found: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The rows with a new text, and the declared length that belongs to it."""
    new = {"text": text, "n_chars": F.length(text).cast(docs.schema["n_chars"].dataType)}
    return found.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose co-trained score (wanted: good and not toxic) is 0.5 or more."""
    scored = cotraining.score_documents(docs, table(spark, sf_dir, "labels"))
    return scored.where(F.col("score") >= KEEP_FROM).select("row.*")


def unique_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One occurrence of each group of alike lines stays; documents of which nothing is left go."""
    found = lines.dedup_lines(docs).where("n_removed = 0 or has_text")
    return _with_text(found, docs, F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("row.text")))


def unique_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near-duplicate documents stays: that with the smallest id (null last), then text hash.

    Rows without words are in no component and stay."""
    key = F.xxhash64("doc_id", "th")
    with working_tables(spark):
        groups = jaccard.near_duplicates(docs).withColumn("key", key)
        place = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)), "th", "key")
        first = groups.where("component is not null").groupBy("component").agg(F.min(place).alias("p")).select("p.key")
        counted = groups.where("component is not null").groupBy("key").agg(F.count("*").alias("n")).join(first, "key")
        alone = groups.where("component is null").select("key", F.lit(0).cast("long").alias("n")).distinct()
        stay = written(counted.unionAll(alone), "stay", outlives=True)
    rows = docs.select(F.struct("*").alias("row"), "doc_id", F.xxhash64(text_or_empty("text")).alias("th")).select("row", key.alias("key"))
    kept = rows.join(stay, "key")
    repeated = kept.where("n > 1").dropDuplicates(["key"])  # rows of one id and text
    return kept.where("n < 2").unionAll(repeated).select("row.*")


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside benchmark windows are cut out of the texts."""
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"))
    return _with_text(found, docs, F.when(F.col("n_hit") > 0, F.col("kept_text")).otherwise(F.col("row.text")))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text: ``(doc_id, lang, source, n_tokens, ids, decoded)``."""
    found = bpe.encode(docs, public_tokenizers.path(TOKENIZER))
    return found.select("row.doc_id", "row.lang", "row.source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("line_dedup", unique_lines),
    ("ngram_jaccard_join", unique_documents),
    ("benchmark_decontamination", without_benchmark),
    ("bpe_encoding", token_ids),
]

# The classifier's weights and SimHash groups are not SQL: tests hold each stage against a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
