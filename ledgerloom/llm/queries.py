"""The registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    decontaminate,
    fingerprints,
    language_id,
    lexical_search,
    link_rank,
    near_dedup,
    packing,
    pii,
    sql,
    substrings,
    token_files,
    toxicity,
    whitening,
)
from ledgerloom.llm.tables import in_fold, stored
from ledgerloom.sources.workspace import new_folder

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    found = language_id.identify(docs, language_id.learn(docs))
    return found.withColumn("held_out", in_fold(F.col("doc_id")))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(_documents(spark, sf_dir))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir), size=3, percent=85)


def op5_link_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link_rank.verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return found.select("page_id", "host", "path", "rule", "verdict")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    marked = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", marked), (-7, 1, "assistant", marked)], given.schema)
    records = chat.records_of(given.unionByName(more))
    return chat.digest(stored(chat.format_records(records), "chats"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(_documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write_tokens(_documents(spark, sf_dir), TOKENIZER, path)
    return token_files.token_index(spark, path)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_lengths(_documents(spark, sf_dir), TOKENIZER))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).withColumn("held_out", in_fold(F.col("doc_id")))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.drop_repeats(_documents(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "op1_language_id": op1_language_id,
        "op2_decontamination": op2_decontamination,
        "op3_multiset_hash": op3_multiset_hash,
        "op4_near_dedup": op4_near_dedup,
        "op5_link_rank": op5_link_rank,
        "op6_chat_format": op6_chat_format,
        "op7_pii": op7_pii,
        "op8_token_files": op8_token_files,
        "op9_packing": op9_packing,
        "op10_toxicity": op10_toxicity,
        "op11_lexical_search": op11_lexical_search,
        "op12_whitening": op12_whitening,
        "op13_substring_dedup": op13_substring_dedup,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_near_dedup": sql.NEAR_DEDUP,
        "op5_link_rank": sql.LINK_RANK,
        "op6_chat_format": sql.CHAT_FORMAT,
        "op11_lexical_search": sql.LEXICAL_SEARCH,
        "op13_substring_dedup": sql.SUBSTRING_DEDUP,
    }
