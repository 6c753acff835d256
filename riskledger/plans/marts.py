"""The four reporting tables.

Each is a grain plus a function of that grain's additive sums, so it can be built from
a group-by over the payments or read from the shared rollup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.functions.measures import present, share_pct
from riskledger.operators.merchants import WORST_FIRST, merchant_risk_tier
from riskledger.plans.rollup import Report
from riskledger.schema import DAILY, FAILED, FAILURE, HOURLY, MERCHANT

# The smallest group reported, and the reported columns in order.
MERCHANT_MIN_TRANSACTIONS = 20

KPI_COLUMNS = [
    "total_transactions",
    "total_payment_volume",
    "approved_transactions",
    "failed_transactions",
    "fraud_transactions",
    "chargeback_transactions",
    "approval_rate_pct",
    "failure_rate_pct",
    "fraud_rate_pct",
    "chargeback_rate_pct",
]
RISK_RATES = ["failure_rate_pct", "fraud_rate_pct", "chargeback_rate_pct"]
RISK_COUNTS = ["failed_transactions", "fraud_transactions", "chargeback_transactions"]


def present_daily(summary: DataFrame) -> DataFrame:
    return present(summary, ["transaction_date", *KPI_COLUMNS])


def present_merchants(summary: DataFrame) -> DataFrame:
    """Per merchant and category, for groups large enough to judge."""
    enough = summary.filter(F.col("total_transactions") >= MERCHANT_MIN_TRANSACTIONS)
    figures = present(
        enough,
        [
            "merchant_id",
            "merchant_category",
            "total_transactions",
            "total_payment_volume",
            "avg_transaction_amount",
            *RISK_COUNTS,
            *RISK_RATES,
        ],
    )
    return figures.withColumn("merchant_risk_level", merchant_risk_tier())


def failed_payments(txn: DataFrame) -> DataFrame:
    return txn.filter(F.col("transaction_status") == FAILED)


def present_failures(summary: DataFrame) -> DataFrame:
    counts = summary.filter(F.col("failed_transactions") > 0).select(
        "failure_reason", F.col("failed_transactions").alias("transaction_count")
    )
    return counts.withColumn(
        "pct_of_failed_transactions", share_pct("transaction_count", counts)
    )


def present_hourly(summary: DataFrame) -> DataFrame:
    columns = ["hour", "total_transactions", *RISK_COUNTS, *RISK_RATES]
    return present(summary, columns)


MOST_FAILED = ("-transaction_count", "failure_reason")
MARTS: dict[str, Report] = {
    DAILY: Report("daily", present_daily, order=("transaction_date",)),
    MERCHANT: Report("merchant", present_merchants, order=WORST_FIRST),
    FAILURE: Report("reason", present_failures, rows=failed_payments, order=MOST_FAILED),
    HOURLY: Report("hourly", present_hourly, order=("hour",)),
}

# The order in which a stored mart is exported.
EXPORT_ORDER: dict[str, list[str]] = {name: list(mart.order) for name, mart in MARTS.items()}
