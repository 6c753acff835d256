"""The corpus pipeline: five stages over ``documents``, each written and read back.

Stages take (spark, docs, sf_dir) and work on all documents the one before kept. All but the
last return the columns of ``documents``; the last returns token ids per document. Language
and benchmark models are fitted anew on what the stage is given, by the operators' own rules.

Defined cases are those of the operators: documents without a letter leave at the first
stage, so later stages see no null texts; an empty table passes through all stages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskledger.llm import (
    decontamination,
    language_id,
    line_dedup,
    ngram_join,
    sentencepiece_codec,
)
from riskledger.llm.storage import Scratch, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter: no least score is set, so only undetermined ones go."""
    return language_id.keep_identified(docs, language_id.fit(docs))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that stand on too many pages of their host.

    Exact copies on a host are one page, so copies alone don't make their lines boilerplate.
    """
    return line_dedup.drop_boilerplate(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies."""
    return ngram_join.keep_one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of what is left."""
    return sentencepiece_codec.encode_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("line_dedup", drop_boilerplate_lines),
    ("ngram_join", drop_near_duplicates),
    ("decontamination", drop_benchmark_passages),
    ("sentencepiece", encode_pieces),
]

#: Fitted models, similarity components and tokenisation are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``; each result is stored before the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch.write(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
