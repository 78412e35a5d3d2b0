"""A training corpus from the documents table, in five stages.

Each stage takes all that the one before kept; ``run`` stores every stage's result in
the shared folder and goes on from what it reads there.

The stages run in the same executors and Python processes, one after another, and what
one of them holds adds up with the others': texts go from step to step a few MB at a time.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import decontaminate, language_id, near_dedup, packing, pii
from ledgerloom.llm.tables import small_batches, stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
MOST_WORDS = 300_000  # that the last stage remembers in a Python process


def drop_unknown_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in one or several of the languages learned from the documents stay."""
    small_batches(spark)
    return language_id.drop_unknown(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays: the one with the smallest id.
    Documents are linked from a similarity of 0.8 of their five-word shingles on."""
    small_batches(spark)
    return near_dedup.drop_near_duplicates(docs, size=5, percent=80)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark stay."""
    small_batches(spark)
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay; personal data in their texts give way to the kind's name."""
    small_batches(spark)
    return pii.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of the permitted lengths, as lists of document ids and token ranges."""
    small_batches(spark)
    return packing.pack(packing.token_lengths(docs, TOKENIZER, MOST_WORDS))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", drop_unknown_languages),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

# Trained models, hashed signatures and a tokenizer: DuckDB can't express them.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences made of ``documents``, each stage applied to all the last one kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
