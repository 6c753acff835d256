"""The named business questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskledger.functions.measures import present
from riskledger.operators.merchants import high_risk_merchants
from riskledger.operators.scoring import present_levels
from riskledger.plans.marts import (
    KPI_COLUMNS,
    MOST_FAILED,
    RISK_RATES,
    failed_payments,
    present_daily,
    present_failures,
    present_merchants,
)
from riskledger.plans.rollup import Report

# Fixed value: the smallest location reported.
LOCATION_MIN_TRANSACTIONS = 100


def executive_payment_kpis(summary: DataFrame) -> DataFrame:
    return present(summary, KPI_COLUMNS)


def daily_payment_trend(summary: DataFrame) -> DataFrame:
    return present_daily(summary).select(
        "transaction_date",
        "total_transactions",
        "total_payment_volume",
        "approval_rate_pct",
        *RISK_RATES,
    )


def top_high_risk_merchants(summary: DataFrame) -> DataFrame:
    return high_risk_merchants(present_merchants(summary))


def ranked(summary: DataFrame, key: str, columns: list[str], by: str) -> DataFrame:
    """Figures per key, highest ``by`` first, the key deciding among equals."""
    return present(summary, [key, *columns]).orderBy(F.desc(by), key)


def fraud_by_channel(summary: DataFrame) -> DataFrame:
    columns = ["total_transactions", "fraud_transactions", "fraud_rate_pct"]
    return ranked(summary, "channel", [*columns, "avg_transaction_amount"], "fraud_rate_pct")


def chargeback_by_category(summary: DataFrame) -> DataFrame:
    columns = ["total_transactions", "chargebacks", "chargeback_rate_pct", "total_payment_volume"]
    return ranked(summary, "merchant_category", columns, "chargeback_rate_pct")


def compared(
    summary: DataFrame, flag: str, name: str, labels: tuple[str, str], average: str, by: str
) -> DataFrame:
    """One row per value of a 0/1 flag, shown under a label (second label: everything else)."""
    columns = ["total_transactions", average, *RISK_RATES]
    label = F.when(F.col(flag) == 1, labels[0]).otherwise(labels[1])
    figures = present(summary, [flag, *columns])
    return figures.select(label.alias(name), *columns).orderBy(F.desc(by), name)


def weekend_vs_weekday_risk(summary: DataFrame) -> DataFrame:
    labels = ("Weekend", "Weekday")
    return compared(
        summary, "is_weekend", "day_type", labels, "avg_transaction_amount", "fraud_rate_pct"
    )


def slow_response_impact(summary: DataFrame) -> DataFrame:
    return compared(
        summary,
        "slow_response",
        "response_type",
        ("Slow Response", "Normal Response"),
        "avg_processor_response_ms",
        "failure_rate_pct",
    )


def high_value_risk(summary: DataFrame) -> DataFrame:
    return compared(
        summary,
        "high_value_txn",
        "transaction_value_type",
        ("High Value", "Standard Value"),
        "avg_transaction_amount",
        "fraud_rate_pct",
    )


def payment_method_performance(summary: DataFrame) -> DataFrame:
    columns = ["total_transactions", "total_payment_volume", "avg_transaction_amount", *RISK_RATES]
    return ranked(summary, "payment_method", columns, "failure_rate_pct")


def monthly_risk_trend(summary: DataFrame) -> DataFrame:
    """Calendar months; the same month of different years counts together."""
    columns = ["month", "total_transactions", "total_payment_volume", *RISK_RATES]
    return present(summary, columns).orderBy("month")


def location_based_risk(summary: DataFrame) -> DataFrame:
    enough = summary.filter(F.col("total_transactions") >= LOCATION_MIN_TRANSACTIONS)
    columns = ["total_transactions", "total_payment_volume", *RISK_RATES]
    return ranked(enough, "customer_location", columns, "fraud_rate_pct")


QUESTIONS: dict[str, Report] = {
    "executive_payment_kpis": Report("overall", executive_payment_kpis),
    "daily_payment_trend": Report("daily", daily_payment_trend, order=("transaction_date",)),
    "top_failure_reasons": Report(
        "reason", present_failures, rows=failed_payments, order=MOST_FAILED
    ),
    "high_risk_merchants": Report("merchant", top_high_risk_merchants),
    "fraud_by_channel": Report("channel", fraud_by_channel),
    "chargeback_by_category": Report("category", chargeback_by_category),
    "weekend_vs_weekday_risk": Report("weekend", weekend_vs_weekday_risk),
    "slow_response_impact": Report("response", slow_response_impact),
    "high_value_risk": Report("value", high_value_risk),
    "payment_method_performance": Report("method", payment_method_performance),
    "monthly_risk_trend": Report("monthly", monthly_risk_trend),
    "location_based_risk": Report("location", location_based_risk),
}
RISK_LEVELS = Report("level", present_levels)
