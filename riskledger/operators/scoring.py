"""Rule-based risk scoring: one codegen'd projection, no shuffle, no UDF."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskledger.functions.measures import average_sql
from riskledger.functions.risk_rules import (
    POST_TXN,
    PRE_TXN,
    level_of,
    reason_text_of,
    reasons_of,
    score_of,
)
from riskledger.operators.ranking import first_rows

# The columns of the report, in order.
TOP_RISK_COLUMNS = [
    "transaction_id",
    "customer_id",
    "merchant_id",
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
    "risk_reason",
]


def score_transactions(txn: DataFrame, keep_reason_list: bool = False) -> DataFrame:
    """Score known outcomes included: adds risk_score, risk_level and risk_reason."""
    scored = txn.withColumn("risk_score", score_of(POST_TXN)).withColumns(
        {"risk_level": level_of("risk_score"), "risk_reason": reason_text_of(POST_TXN)}
    )
    if keep_reason_list:
        scored = scored.withColumn("risk_reasons", reasons_of(POST_TXN))
    return scored


def score_in_flight(txn: DataFrame) -> DataFrame:
    """Score from what is known while the payment is processed (no fraud or chargeback)."""
    return txn.withColumn("pre_txn_risk_score", score_of(PRE_TXN)).withColumn(
        "pre_txn_risk_level", level_of("pre_txn_risk_score")
    )


def present_levels(levels: DataFrame) -> DataFrame:
    """Size, mean score and share of each level, from counts and score sums.

    The window has no partition on purpose: there are four levels, so four rows.
    """
    average = F.expr(average_sql("score_total"))
    everything = F.sum("total_transactions").over(W.partitionBy())
    share = F.round(F.try_divide(F.lit(100.0) * F.col("total_transactions"), everything), 2)
    return levels.select(
        "risk_level",
        F.col("total_transactions").alias("transactions"),
        average.alias("avg_risk_score"),
        share.alias("pct_total"),
    ).orderBy(F.desc("avg_risk_score"), "risk_level")


def risk_level_summary(scored: DataFrame) -> DataFrame:
    levels = scored.groupBy("risk_level").agg(
        F.count("*").alias("total_transactions"), F.sum("risk_score").alias("score_total")
    )
    return present_levels(levels)


def top_risk_transactions(scored: DataFrame, n: int = 25) -> DataFrame:
    """Highest scores first, the id decides among equals."""
    rows = scored.select(*TOP_RISK_COLUMNS)
    return first_rows(rows, n, F.desc("risk_score"), "transaction_id")
