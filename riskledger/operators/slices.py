"""Dashboard slices: optional equality filters and the figures shown for a slice."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.functions.display import currency, percent, thousands
from riskledger.functions.measures import raw_rate_pct, summarise
from riskledger.operators.ranking import first_rows
from riskledger.schema import FAILED

ALL = "All"
# The columns offered as filters or form fields.
OPTION_COLUMNS = [
    "merchant_category",
    "channel",
    "payment_method",
    "device_type",
    "customer_location",
    "transaction_status",
]
# The columns of the preview, in order.
PREVIEW_COLUMNS = [
    "transaction_id",
    "transaction_amount",
    "payment_method",
    "channel",
    "merchant_category",
    "customer_location",
    "transaction_status",
    "is_fraud",
    "is_chargeback",
    "risk_score",
    "risk_level",
]

SLICE_COLUMNS = [*PREVIEW_COLUMNS, "device_type", "failure_reason", "processor_response_ms", "hour"]


def slice_payments(
    scored: DataFrame,
    merchant_category: str | None = None,
    channel: str | None = None,
    payment_method: str | None = None,
) -> DataFrame:
    """Rows matching every filter given; ``None`` or ``"All"`` does not filter."""
    wanted = {
        "merchant_category": merchant_category,
        "channel": channel,
        "payment_method": payment_method,
    }
    for column, value in wanted.items():
        if value is not None and value != ALL:
            scored = scored.filter(F.col(column) == value)
    return scored


def slice_kpis(payments: DataFrame) -> DataFrame:
    """Count, volume and unrounded rates; rates are null for an empty slice.

    Fraud and chargeback rates are means of the flags, over the rows that have the flag.
    """
    return summarise(payments).select(
        "total_transactions",
        F.coalesce(F.col("amount_total").cast("double"), F.lit(0.0)).alias("total_volume"),
        raw_rate_pct("approved_transactions").alias("approval_rate"),
        raw_rate_pct("failed_transactions").alias("failure_rate"),
        raw_rate_pct("fraud_transactions", "fraud_known").alias("fraud_rate"),
        raw_rate_pct("chargeback_transactions", "chargeback_known").alias("chargeback_rate"),
    )


def slice_kpi_cards(payments: DataFrame) -> DataFrame:
    """The same figures as display text."""
    rates = ["approval_rate", "failure_rate", "fraud_rate", "chargeback_rate"]
    return slice_kpis(payments).select(
        thousands("total_transactions").alias("total_transactions"),
        currency("total_volume").alias("total_volume"),
        *[percent(r).alias(r) for r in rates],
    )


def fraud_rate_by(payments: DataFrame, key: str) -> DataFrame:
    """Transactions, fraud and unrounded fraud rate per non-null key."""
    return (
        payments.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("transaction_id").alias("total_transactions"),
            F.sum("is_fraud").alias("fraud_transactions"),
        )
        .withColumn("fraud_rate_pct", raw_rate_pct("fraud_transactions"))
        .orderBy(key)
    )


def slice_fraud_by_channel(payments: DataFrame) -> DataFrame:
    return fraud_rate_by(payments, "channel")


def slice_hourly_fraud(payments: DataFrame) -> DataFrame:
    return fraud_rate_by(payments, "hour")


def value_counts(payments: DataFrame, column: str, name: str) -> DataFrame:
    """Rows per non-null value, most frequent first."""
    return (
        payments.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias(name))
        .orderBy(F.desc(name), column)
    )


def slice_failure_counts(payments: DataFrame) -> DataFrame:
    failed = payments.filter(F.col("transaction_status") == FAILED)
    return value_counts(failed, "failure_reason", "count")


def slice_risk_distribution(payments: DataFrame) -> DataFrame:
    return value_counts(payments, "risk_level", "transactions")


def transaction_preview(payments: DataFrame, n: int = 100) -> DataFrame:
    return first_rows(payments.select(*PREVIEW_COLUMNS), n, "transaction_id")


@contextlib.contextmanager
def cached_payments(scored: DataFrame) -> Iterator[DataFrame]:
    """The columns slices need, kept for repeated questions; spills to executor disks."""
    kept = scored.select(*SLICE_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()
