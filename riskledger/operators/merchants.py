"""Merchant risk tiers and the merchant rankings built on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.operators.ranking import first_rows

HIGH_RISK = "High Risk"

# The lowest rate, in percent, that puts a merchant into a tier.
TIERS = (
    (HIGH_RISK, {"fraud_rate_pct": 8, "chargeback_rate_pct": 4, "failure_rate_pct": 15}),
    ("Medium Risk", {"fraud_rate_pct": 5, "chargeback_rate_pct": 2.5, "failure_rate_pct": 10}),
)
LOWEST_TIER = "Low Risk"

# The columns of the rankings, in order.
RANKING_COLUMNS = [
    "merchant_id",
    "merchant_category",
    "total_transactions",
    "total_payment_volume",
    "avg_transaction_amount",
    "failure_rate_pct",
    "fraud_rate_pct",
    "chargeback_rate_pct",
    "merchant_risk_level",
]
TOP_FIVE_COLUMNS = [
    c for c in RANKING_COLUMNS if c not in ("total_payment_volume", "avg_transaction_amount")
]


def merchant_risk_tier() -> Column:
    """Tier from the already rounded rates: any one rate at its floor is enough."""
    tier = F.lit(LOWEST_TIER)
    for name, floors in reversed(TIERS):
        reached = F.lit(False)
        for rate, floor in floors.items():
            reached = reached | (F.col(rate) >= floor)
        tier = F.when(reached, name).otherwise(tier)
    return tier


def only_high_risk(merchants: DataFrame) -> DataFrame:
    return merchants.filter(F.col("merchant_risk_level") == HIGH_RISK)


def by_rates(*rates: str) -> list[Column | str]:
    """Highest rates first; the group key decides among equals."""
    return [*[F.desc(r) for r in rates], "merchant_id", "merchant_category"]


BY_FRAUD = ("fraud_rate_pct", "chargeback_rate_pct")
#: The same order as names, descending ones with a minus sign.
WORST_FIRST = (*[f"-{rate}" for rate in BY_FRAUD], "merchant_id", "merchant_category")


def high_risk_merchants(merchants: DataFrame, n: int = 25) -> DataFrame:
    chosen = only_high_risk(merchants).select(*RANKING_COLUMNS)
    return first_rows(chosen, n, *by_rates(*BY_FRAUD))


def high_risk_merchants_dashboard(merchants: DataFrame, n: int = 25) -> DataFrame:
    """All columns, and the failure rate decides among equal fraud and chargeback rates."""
    return first_rows(only_high_risk(merchants), n, *by_rates(*BY_FRAUD, "failure_rate_pct"))


def merchant_top5(merchants: DataFrame) -> DataFrame:
    return first_rows(merchants.select(*TOP_FIVE_COLUMNS), 5, *by_rates(*BY_FRAUD))
