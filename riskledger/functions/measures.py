"""Additive measures and the figures derived from them.

Every report is built in two steps. ``summarise`` produces additive sums only (longs and
decimals, so partial aggregation collapses a hot key inside each map task and the result
does not depend on the order rows arrive in). ``present`` then turns the sums into the reported
figures. Because step two needs nothing but sums, the same figures can be read from a
direct group-by or from a shared rollup.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.schema import APPROVED, FAILED

# What each payment adds to the sums. Amounts keep six decimals, which sum exactly; only the
# reported figures are rounded.
INPUTS = {
    "amount_total": "cast(transaction_amount AS decimal(24, 6))",
    "approved_transactions": f"cast(transaction_status = '{APPROVED}' AS int)",
    "failed_transactions": f"cast(transaction_status = '{FAILED}' AS int)",
    "fraud_transactions": "is_fraud",
    "chargeback_transactions": "is_chargeback",
    "fraud_known": "cast(is_fraud IS NOT NULL AS int)",
    "chargeback_known": "cast(is_chargeback IS NOT NULL AS int)",
    "response_ms_total": "processor_response_ms",
}


def measure_inputs() -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in INPUTS.items()]


def additive_measures() -> list[Column]:
    """Sums over ``measure_inputs``."""
    sums = [F.sum(name).alias(name) for name in INPUTS]
    return [F.count("*").alias("total_transactions"), *sums]


def summarise(df: DataFrame, *keys: str) -> DataFrame:
    """All additive measures per key; the optimizer drops the ones nobody reads."""
    return df.select(*keys, *measure_inputs()).groupBy(*keys).agg(*additive_measures())


def rate_pct(part: str, whole: str = "total_transactions") -> Column:
    """Percentage with two decimals; null when there is nothing to divide by."""
    return F.expr(rate_sql(part, whole))


def rate_sql(part: str, whole: str = "total_transactions") -> str:
    return f"round(try_divide(100.0D * {part}, {whole}), 2)"


def raw_rate_pct(part: str, whole: str = "total_transactions") -> Column:
    """Unrounded percentage, as the dashboard figures use."""
    return F.expr(f"try_divide({part}, {whole}) * 100")


def average_sql(total: str, n: str = "total_transactions") -> str:
    """Two-decimal mean, rounded in decimal so that halves always round up."""
    mean = f"try_divide(cast({total} AS decimal(30, 6)), cast({n} AS decimal(19, 0)))"
    return f"cast(round({mean}, 2) AS double)"


DERIVED = {
    "total_payment_volume": "cast(round(amount_total, 2) AS double)",
    "avg_transaction_amount": average_sql("amount_total"),
    "avg_processor_response_ms": average_sql("response_ms_total"),
    "approval_rate_pct": rate_sql("approved_transactions"),
    "failure_rate_pct": rate_sql("failed_transactions"),
    "fraud_rate_pct": rate_sql("fraud_transactions"),
    "chargeback_rate_pct": rate_sql("chargeback_transactions"),
    "chargebacks": "chargeback_transactions",
}


def present(summary: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select keys, sums and derived figures by name, in the order given."""
    return summary.selectExpr(*[f"{DERIVED[c]} AS {c}" if c in DERIVED else c for c in columns])


def share_pct(part: str, parts: DataFrame) -> Column:
    """Percentage of the total of ``part`` over a (small, grouped) frame.

    The total is a scalar subquery over the same grouped frame, so Spark reuses the
    shuffled aggregate instead of scanning the fact table a second time.
    """
    total = parts.agg(F.sum(part)).scalar()
    return F.round(F.try_divide(F.lit(100.0) * F.col(part), total), 2)
