"""Alerts for merchants whose share of fraud jumps above their own recent past.

Payments are counted per merchant and window of whole days, aligned to 1970-01-01. A window
raises an alert when it has at least ``least`` fraudulent payments and its share of fraud is at
least ``factor`` times the merchant's share over the ``baseline`` windows before it. Shares
are compared as products of whole numbers, so no rounding decides.

Counts are additive: those of parts of the payments, in any order, add up to those of all.
The only window function runs over the counts of one merchant, a row per window.

Defined cases: payments without a time, or whose fraud flag is unknown, count nowhere; a merchant
that is null is a merchant of its own; without a payment in the windows before there is no
past to compare with and no alert; a past without fraud is exceeded by any ``least`` cases.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskledger.functions.measures import rate_pct

#: Days of a window, windows of the past, frauds an alert needs, and the jump.
DAYS, BASELINE, LEAST, FACTOR = 7, 4, 3, 2

WINDOW, PAYMENTS, FRAUDS = "window_number", "payments", "frauds"


def window_counts(payments: DataFrame, days: int = DAYS) -> DataFrame:
    """(merchant_id, window_number, payments, frauds) of the payments that can be judged."""
    day = F.unix_date(F.to_date("transaction_datetime"))
    return (
        payments.filter(F.col("transaction_datetime").isNotNull() & F.col("is_fraud").isNotNull())
        .select("merchant_id", F.floor(day / days).alias(WINDOW), "is_fraud")
        .groupBy("merchant_id", WINDOW)
        .agg(F.count("*").alias(PAYMENTS), F.sum(F.col("is_fraud").cast("bigint")).alias(FRAUDS))
    )


def added_up(counts: DataFrame) -> DataFrame:
    """Counts of all payments from counts of parts of them."""
    return counts.groupBy("merchant_id", WINDOW).agg(
        F.sum(PAYMENTS).alias(PAYMENTS), F.sum(FRAUDS).alias(FRAUDS)
    )


def spikes(
    counts: DataFrame,
    days: int = DAYS,
    baseline: int = BASELINE,
    least: int = LEAST,
    factor: int = FACTOR,
) -> DataFrame:
    """One row per alert, from ``window_counts`` of the same ``days``."""
    before = Window.partitionBy("merchant_id").orderBy(WINDOW).rangeBetween(-baseline, -1)
    past = counts.withColumns(
        {
            "past_payments": F.sum(PAYMENTS).over(before),
            "past_frauds": F.sum(FRAUDS).over(before),
        }
    )
    jumped = F.col(FRAUDS) * F.col("past_payments") >= factor * F.col("past_frauds") * F.col(PAYMENTS)
    start = F.date_from_unix_date((F.col(WINDOW) * days).cast("int"))
    return past.filter((F.col(FRAUDS) >= least) & jumped).select(
        "merchant_id",
        WINDOW,
        start.alias("window_start"),
        PAYMENTS,
        FRAUDS,
        rate_pct(FRAUDS, PAYMENTS).alias("fraud_rate_pct"),
        rate_pct("past_frauds", "past_payments").alias("past_fraud_rate_pct"),
    )
