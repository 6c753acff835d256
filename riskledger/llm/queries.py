"""The registered queries of this package: ``(spark, folder of tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskledger.llm import (
    chat_format,
    decontamination,
    embedding_dedup,
    fill_middle,
    language_id,
    line_dedup,
    ngram_join,
    pii,
    sentencepiece_codec,
    token_alignment,
    token_files,
    toxicity,
    url_filter,
)
from riskledger.llm.storage import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_report(table(spark, sf_dir, "documents"))


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents"))


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.sql(
        "SELECT -7L AS conv_id, t.* FROM VALUES (0L, 'user', '</s>[INST] ok [/INST]'),"
        " (1L, 'assistant', '</s>[INST] ok [/INST]') AS t(turn, role, text)"
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.windows_report(chat_format.format_windows(turns.unionByName(extra)))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf_dir, "pages"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data_report(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(spark, table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.fill_report(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_language_id": op2_language_id,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_ngram_join": op4_ngram_join,
    "op5_chat_format": op5_chat_format,
    "op6_url_filter": op6_url_filter,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_pii": op9_pii,
    "op10_decontamination": op10_decontamination,
    "op11_token_files": op11_token_files,
    "op12_fill_middle": op12_fill_middle,
    "op13_token_alignment": op13_token_alignment,
}

SQL: dict[str, str] = {
    "op1_line_dedup": line_dedup.SQL,
    "op5_chat_format": chat_format.SQL,
    "op12_fill_middle": fill_middle.SQL,
}
