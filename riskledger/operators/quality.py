"""Counts that describe the raw data and what cleaning removed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.functions.measures import rate_pct, summarise
from riskledger.operators.cleaning import has_valid_amount, has_valid_status, is_true


def cleaning_counters(
    raw: DataFrame, quarantined: DataFrame | None = None, clean: DataFrame | None = None
) -> DataFrame:
    """Rows removed by each cleaning step.

    Raw rows are quarantined ones (which never became payments), duplicates, missing and
    invalid amounts, invalid statuses and clean rows; nothing else is lost. Statuses are
    judged among rows whose amount already passed, as the steps run in that order. Of the
    clean rows, ``incomplete_rows`` lack a number or a time and can't be used by models.

    With the ``clean`` rows stored already, these are only counted: rows that pass were made
    distinct when they were stored, and just those that fail are shuffled, to know their
    copies. Without, all raw rows are made distinct here.
    """
    amount = F.col("transaction_amount")
    amount_passes, status_passes = is_true(has_valid_amount()), is_true(has_valid_status())
    passes = amount_passes & status_passes
    missing = amount.isNull() | F.isnan(amount)
    incomplete = F.col("transaction_datetime").isNull() | F.col("processor_response_ms").isNull()
    judged = raw if clean is None else raw.filter(~passes)
    found = judged.groupBy(*raw.columns).agg(F.count("*").alias("copies")).agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("rows"),
        F.count("*").alias("distinct_rows"),
        F.count_if(missing).alias("missing_amounts"),
        F.count_if(~missing & (amount <= 0)).alias("invalid_amounts"),
        F.count_if(amount_passes & ~status_passes).alias("invalid_statuses"),
        F.count_if(passes).alias("clean_rows"),
        F.count_if(passes & incomplete).alias("incomplete_rows"),
    )
    if clean is not None:
        stored = clean.agg(F.count("*")).scalar()
        found = found.withColumns(
            {
                "rows": raw.agg(F.count("*")).scalar(),
                "distinct_rows": F.col("distinct_rows") + stored,
                "clean_rows": stored,
                "incomplete_rows": clean.agg(F.count_if(incomplete)).scalar(),
            }
        )
    held = quarantined.agg(F.count("*")).scalar() if quarantined is not None else F.lit(0)
    return found.select(
        (F.col("rows") + held.cast("bigint")).alias("raw_rows"),
        held.cast("bigint").alias("quarantined_rows"),
        (F.col("rows") - F.col("distinct_rows")).alias("duplicates_removed"),
        "missing_amounts",
        "invalid_amounts",
        "invalid_statuses",
        "clean_rows",
        "incomplete_rows",
    )


def null_profile(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "null_count")


def overall_rates(df: DataFrame) -> DataFrame:
    """Fraud and chargeback rates are over the rows that have the flag."""
    return summarise(df).select(
        rate_pct("approved_transactions").alias("approval_rate_pct"),
        rate_pct("fraud_transactions", "fraud_known").alias("fraud_rate_pct"),
        rate_pct("chargeback_transactions", "chargeback_known").alias("chargeback_rate_pct"),
    )


def raw_status_counts(raw: DataFrame) -> DataFrame:
    return (
        raw.groupBy("transaction_status")
        .agg(F.count("*").alias("transactions"))
        .orderBy(F.desc("transactions"), "transaction_status")
    )


def raw_outcome_rates(raw: DataFrame) -> DataFrame:
    return summarise(raw).select(
        "total_transactions",
        rate_pct("fraud_transactions", "fraud_known").alias("fraud_rate_pct"),
        rate_pct("chargeback_transactions", "chargeback_known").alias("chargeback_rate_pct"),
    )


def label_shares(df: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Share of each label value in percent of the rows that have a label."""
    known = df.filter(F.col(label).isNotNull())
    counts = known.groupBy(label).agg(F.count("*").alias("transactions"))
    total = counts.agg(F.sum("transactions")).scalar()
    share = F.round(F.try_divide(F.lit(100.0) * F.col("transactions"), total), 2)
    return counts.select(label, share.alias("share_pct")).orderBy(F.desc("share_pct"), label)


def distinct_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sorted distinct non-null values of several text columns, in one pass.

    Copies of rows do not matter, so duplicates need not be removed before.
    """
    return (
        df.select(*columns)
        .unpivot([], columns, "column_name", "value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("column_name", "value")
    )
