"""Declared schemas, column lists and the fixed values of the payment domain."""

from __future__ import annotations

from pyspark.sql import types as T

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, "
    "event_type STRING, value DOUBLE, props STRING"
)

# Names, types and order of the payment columns.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("transaction_datetime", T.TimestampNTZType()),
        T.StructField("transaction_amount", T.DoubleType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("device_type", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("customer_location", T.StringType()),
        T.StructField("transaction_status", T.StringType()),
        T.StructField("failure_reason", T.StringType()),
        T.StructField("processor_response_ms", T.IntegerType()),
        T.StructField("is_fraud", T.IntegerType()),
        T.StructField("is_chargeback", T.IntegerType()),
    ]
)
RAW_COLUMNS = RAW_SCHEMA.fieldNames()

DERIVED_COLUMNS = [
    "transaction_date",
    "hour",
    "day_of_week",
    "month",
    "year",
    "is_weekend",
    "is_failed",
    "high_value_txn",
    "slow_response",
]
CLEAN_COLUMNS = RAW_COLUMNS + DERIVED_COLUMNS
SCORE_COLUMNS = ["risk_score", "risk_level", "risk_reason"]
SCORED_COLUMNS = CLEAN_COLUMNS + SCORE_COLUMNS

# Statuses, fill-ins and thresholds that results must agree on.
APPROVED = "Approved"
FAILED = "Failed"
VALID_STATUSES = [APPROVED, FAILED]
FILL_VALUES = {
    "customer_location": "Unknown",
    "merchant_category": "Other",
    "failure_reason": "Not Applicable",
}
NO_FAILURE_TOKEN = "None"
HIGH_VALUE_AMOUNT = 500
SLOW_RESPONSE_MS = 900
DAY_NAMES = [
    "Sunday",
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
]

# Text a CSV cell may hold to mean "missing".
MISSING_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Table names a report reader can query.
TRANSACTIONS = "payment_transactions"
SCORED = "payment_transactions_scored"
DAILY = "daily_payment_kpis"
MERCHANT = "merchant_risk_summary"
FAILURE = "failure_reason_summary"
HOURLY = "hourly_risk_summary"
MART_NAMES = [DAILY, MERCHANT, FAILURE, HOURLY]
