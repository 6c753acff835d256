"""Raw payments derived from the ``events`` table (mapping in FIXTURES.md).

The mapping also plants exact copies, missing values, zero amounts and an invalid
status, so every cleaning step has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskledger.schema import EVENTS_SCHEMA, RAW_COLUMNS

# Position in the list is the remainder that selects the entry.
CATEGORIES = [
    "Retail",
    "Grocery",
    "Fuel",
    "Travel",
    "Restaurant",
    "Electronics",
    "Healthcare",
    "Entertainment",
    "Financial Services",
    "Subscription",
]
LOCATIONS = [
    "CA", "TX", "NY", "FL", "IL", "WA", "OR", "AZ", "GA", "NC", "CO", "NV", "OH", "PA", "MA",
]
DEVICES = ["Desktop", "Mobile", "Tablet", "POS Terminal"]
FAILURES = [
    "Insufficient Funds",
    "Expired Card",
    "Suspected Fraud",
    "Invalid Account",
    "Processor Timeout",
    "Network Error",
    "Merchant Decline",
    "Card Limit Exceeded",
]


def pick(values: list[str], index: str) -> str:
    """SQL for the entry at a zero-based index, null past the end of the list."""
    entries = ", ".join(f"'{v}'" for v in values)
    return f"get(array({entries}), cast({index} AS int))"


def padded_id(prefix: str, number: str, width: int) -> str:
    """SQL for ``prefix`` plus zero-padded digits; wider numbers are kept whole."""
    digits = f"cast({number} AS string)"
    return f"concat('{prefix}', lpad({digits}, greatest({width}, length({digits})), '0'))"


IS_FAILURE = "event_type = 'error' AND k < 40"
PAYMENT_COLUMNS = {
    "transaction_id": padded_id("TXN", "event_id", 8),
    "customer_id": padded_id("CUST", "user_id", 6),
    "merchant_id": padded_id("MERCH", "k % 37", 5),
    "transaction_datetime": "ts + make_dt_interval(k * 3)",
    "transaction_amount": "CASE WHEN event_id % 991 = 0 THEN 0.0D "
    "WHEN event_id % 23 = 0 THEN value * 10 ELSE value END",
    "payment_method": "CASE WHEN k < 42 THEN 'Credit Card' WHEN k < 73 THEN 'Debit Card' "
    "WHEN k < 85 THEN 'ACH' ELSE 'Digital Wallet' END",
    "channel": "CASE WHEN event_id % 20 < 9 THEN 'Online' WHEN event_id % 20 < 16 "
    "THEN 'In-Store' ELSE 'Mobile App' END",
    "device_type": pick(DEVICES, "user_id % 4"),
    "merchant_category": pick(CATEGORIES, "event_id % 11"),
    "customer_location": pick(LOCATIONS, "user_id % 16"),
    "transaction_status": "CASE WHEN event_id % 997 = 0 THEN 'Pending' "
    f"WHEN {IS_FAILURE} THEN 'Failed' ELSE 'Approved' END",
    "failure_reason": f"CASE WHEN {IS_FAILURE} THEN {pick(FAILURES, 'event_id % 8')} "
    "ELSE 'None' END",
    "processor_response_ms": "cast(80 + (event_id * 37 + user_id * 13) % 900 AS int)",
    "is_fraud": "CASE WHEN (event_type = 'signup' AND k < 20) "
    "OR (event_type = 'error' AND k < 4) THEN 1 ELSE 0 END",
    "is_chargeback": "CASE WHEN (event_type = 'purchase' AND k < 10) "
    "OR (event_type = 'signup' AND k < 4) THEN 1 ELSE 0 END",
}
# Every hundredth event appears twice. Repeating it inside the scan's own stage reads the
# table once, where a union of two filters would read it twice.
COPIES = "explode(CASE WHEN event_id % 100 = 0 THEN array(1, 2) ELSE array(1) END)"


def payments_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    payments = [f"{sql} AS {name}" for name, sql in PAYMENT_COLUMNS.items()]
    return (
        events.selectExpr("*", "cast(get_json_object(props, '$.k') AS int) AS k")
        .selectExpr(*payments, f"{COPIES} AS copy")
        .select(*RAW_COLUMNS)
    )
