"""The registered queries as DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

# Both sides start from the mapping of ``events`` to raw payments in FIXTURES.md.
RAW = """
WITH e AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events),
once AS (
  SELECT
    concat('TXN', lpad(CAST(event_id AS VARCHAR), 8, '0')) AS transaction_id,
    concat('CUST', lpad(CAST(user_id AS VARCHAR), 6, '0')) AS customer_id,
    concat('MERCH', lpad(CAST(k % 37 AS VARCHAR), 5, '0')) AS merchant_id,
    ts + to_days(k * 3) AS transaction_datetime,
    CASE WHEN event_id % 991 = 0 THEN 0.0E0 WHEN event_id % 23 = 0 THEN value * 10
         ELSE value END AS transaction_amount,
    CASE WHEN k < 42 THEN 'Credit Card' WHEN k < 73 THEN 'Debit Card' WHEN k < 85 THEN 'ACH'
         ELSE 'Digital Wallet' END AS payment_method,
    CASE WHEN event_id % 20 < 9 THEN 'Online' WHEN event_id % 20 < 16 THEN 'In-Store'
         ELSE 'Mobile App' END AS channel,
    CASE user_id % 4 WHEN 0 THEN 'Desktop' WHEN 1 THEN 'Mobile' WHEN 2 THEN 'Tablet'
         ELSE 'POS Terminal' END AS device_type,
    CASE event_id % 11 WHEN 0 THEN 'Retail' WHEN 1 THEN 'Grocery' WHEN 2 THEN 'Fuel'
         WHEN 3 THEN 'Travel' WHEN 4 THEN 'Restaurant' WHEN 5 THEN 'Electronics'
         WHEN 6 THEN 'Healthcare' WHEN 7 THEN 'Entertainment' WHEN 8 THEN 'Financial Services'
         WHEN 9 THEN 'Subscription' END AS merchant_category,
    CASE user_id % 16 WHEN 0 THEN 'CA' WHEN 1 THEN 'TX' WHEN 2 THEN 'NY' WHEN 3 THEN 'FL'
         WHEN 4 THEN 'IL' WHEN 5 THEN 'WA' WHEN 6 THEN 'OR' WHEN 7 THEN 'AZ' WHEN 8 THEN 'GA'
         WHEN 9 THEN 'NC' WHEN 10 THEN 'CO' WHEN 11 THEN 'NV' WHEN 12 THEN 'OH'
         WHEN 13 THEN 'PA' WHEN 14 THEN 'MA' END AS customer_location,
    CASE WHEN event_id % 997 = 0 THEN 'Pending'
         WHEN event_type = 'error' AND k < 40 THEN 'Failed' ELSE 'Approved'
         END AS transaction_status,
    CASE WHEN event_type = 'error' AND k < 40 THEN
         CASE event_id % 8 WHEN 0 THEN 'Insufficient Funds' WHEN 1 THEN 'Expired Card'
              WHEN 2 THEN 'Suspected Fraud' WHEN 3 THEN 'Invalid Account'
              WHEN 4 THEN 'Processor Timeout' WHEN 5 THEN 'Network Error'
              WHEN 6 THEN 'Merchant Decline' ELSE 'Card Limit Exceeded' END
         ELSE 'None' END AS failure_reason,
    CAST(80 + (event_id * 37 + user_id * 13) % 900 AS INT) AS processor_response_ms,
    CASE WHEN (event_type = 'signup' AND k < 20) OR (event_type = 'error' AND k < 4)
         THEN 1 ELSE 0 END AS is_fraud,
    CASE WHEN (event_type = 'purchase' AND k < 10) OR (event_type = 'signup' AND k < 4)
         THEN 1 ELSE 0 END AS is_chargeback,
    event_id
  FROM e),
raw AS (
  SELECT * EXCLUDE (event_id) FROM once
  UNION ALL
  SELECT * EXCLUDE (event_id) FROM once WHERE event_id % 100 = 0)"""

UNIQUE = RAW + ", uniq AS (SELECT DISTINCT * FROM raw)"

FILLED = """
  SELECT * REPLACE (
    coalesce(merchant_category, 'Other') AS merchant_category,
    coalesce(customer_location, 'Unknown') AS customer_location,
    coalesce(nullif(failure_reason, 'None'), 'Not Applicable') AS failure_reason)
  FROM uniq"""

TIME_PARTS = """
    strftime(transaction_datetime, '%Y-%m-%d') AS transaction_date,
    CAST(extract(hour FROM transaction_datetime) AS INT) AS hour,
    dayname(transaction_datetime) AS day_of_week,
    CAST(extract(month FROM transaction_datetime) AS INT) AS month,
    CAST(extract(year FROM transaction_datetime) AS INT) AS year,
    CASE WHEN dayofweek(transaction_datetime) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""

FLAGS = """
    CASE WHEN transaction_status = 'Failed' THEN 1 ELSE 0 END AS is_failed,
    CASE WHEN transaction_amount >= 500 THEN 1 ELSE 0 END AS high_value_txn,
    CASE WHEN processor_response_ms >= 900 THEN 1 ELSE 0 END AS slow_response"""

TXN = f"""{UNIQUE},
filled AS ({FILLED}),
txn AS (
  SELECT *, {TIME_PARTS}, {FLAGS}
  FROM filled
  WHERE transaction_amount > 0 AND transaction_status IN ('Approved', 'Failed'))"""

IN_FLIGHT_POINTS = """
    (CASE WHEN transaction_amount >= 2000 THEN 30 WHEN transaction_amount >= 1000 THEN 20
          WHEN transaction_amount >= 500 THEN 10 ELSE 0 END
     + 15 * is_failed + 10 * slow_response
     + CASE channel WHEN 'Online' THEN 8 WHEN 'Mobile App' THEN 4 ELSE 0 END
     + CASE WHEN merchant_category IN ('Travel', 'Electronics', 'Financial Services')
            THEN 12 ELSE 0 END
     + CASE WHEN customer_location IN ('FL', 'NV', 'NY') THEN 8 ELSE 0 END)"""


def level(score: str) -> str:
    return (
        f"CASE WHEN {score} >= 75 THEN 'Critical Risk' WHEN {score} >= 50 THEN 'High Risk' "
        f"WHEN {score} >= 25 THEN 'Medium Risk' ELSE 'Low Risk' END"
    )


REASON = """
    coalesce(nullif(concat_ws(', ',
      CASE WHEN transaction_amount >= 2000 THEN 'Very high amount'
           WHEN transaction_amount >= 1000 THEN 'High amount'
           WHEN transaction_amount >= 500 THEN 'Elevated amount' END,
      CASE WHEN is_fraud = 1 THEN 'Fraud indicator' END,
      CASE WHEN is_chargeback = 1 THEN 'Chargeback' END,
      CASE WHEN is_failed = 1 THEN 'Failed transaction' END,
      CASE WHEN slow_response = 1 THEN 'Slow processor response' END,
      CASE channel WHEN 'Online' THEN 'Online channel' WHEN 'Mobile App' THEN 'Mobile channel' END,
      CASE WHEN merchant_category IN ('Travel', 'Electronics', 'Financial Services')
           THEN 'High-risk merchant category' END,
      CASE WHEN customer_location IN ('FL', 'NV', 'NY') THEN 'High-risk location' END),
      ''), 'No major indicators')"""

SCORED = f"""{TXN},
pointed AS (
  SELECT *, CAST({IN_FLIGHT_POINTS} AS INT) AS pre_txn_risk_score,
         CAST({IN_FLIGHT_POINTS} + 40 * is_fraud + 35 * is_chargeback AS INT) AS risk_score
  FROM txn),
scored AS (
  SELECT * EXCLUDE (pre_txn_risk_score), {level("risk_score")} AS risk_level,
         {REASON} AS risk_reason
  FROM pointed)"""

IS_FAILED = "transaction_status = 'Failed'"
IS_APPROVED = "transaction_status = 'Approved'"
IS_FRAUD = "is_fraud = 1"
IS_CHARGEBACK = "is_chargeback = 1"

# Weeks are joined with the four weeks before them.
SPIKES = """weeks AS (
  SELECT merchant_id,
         CAST(floor(date_diff('day', DATE '1970-01-01', CAST(transaction_datetime AS DATE)) / 7)
              AS BIGINT) AS window_number,
         COUNT(*) AS payments, COUNT(*) FILTER (WHERE is_fraud = 1) AS frauds
  FROM txn WHERE transaction_datetime IS NOT NULL AND is_fraud IS NOT NULL
  GROUP BY ALL),
pasts AS (
  SELECT w.merchant_id, w.window_number, w.payments, w.frauds,
         SUM(p.payments) AS past_payments, SUM(p.frauds) AS past_frauds
  FROM weeks w JOIN weeks p ON p.merchant_id IS NOT DISTINCT FROM w.merchant_id
    AND p.window_number BETWEEN w.window_number - 4 AND w.window_number - 1
  GROUP BY ALL),
spikes AS (
  SELECT merchant_id, window_number,
         strftime(DATE '1970-01-01' + CAST(7 * window_number AS INT), '%Y-%m-%d') AS window_start,
         payments, frauds,
         ROUND(100.0E0 * frauds / payments, 2) AS fraud_rate_pct,
         ROUND(100.0E0 * past_frauds / past_payments, 2) AS past_fraud_rate_pct
  FROM pasts WHERE frauds >= 3 AND frauds * past_payments >= 2 * past_frauds * payments)"""


def n(condition: str, name: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition}) AS {name}"


def rate(condition: str, name: str) -> str:
    return f"ROUND(100.0E0 * COUNT(*) FILTER (WHERE {condition}) / COUNT(*), 2) AS {name}"


def mean(column: str, name: str) -> str:
    return f"CAST(ROUND(CAST(AVG({column}) AS DECIMAL(18,8)), 2) AS DOUBLE) AS {name}"


TOTAL = "COUNT(*) AS total_transactions"
EXACT = "SUM(CAST(transaction_amount AS DECIMAL(18,6)))"
VOLUME = f"CAST(ROUND({EXACT}, 2) AS DOUBLE) AS total_payment_volume"
# Whole millionths, halved upwards to hundredths: rounding without floating point.
MICROS = f"CAST({EXACT} * 1000000 AS HUGEINT)"
AVG_AMOUNT = (
    f"CAST(({MICROS} * 2 + COUNT(*) * 10000) // (COUNT(*) * 20000) AS DOUBLE) / 100 "
    "AS avg_transaction_amount"
)
COUNTS = ", ".join(
    [
        n(IS_FAILED, "failed_transactions"),
        n(IS_FRAUD, "fraud_transactions"),
        n(IS_CHARGEBACK, "chargeback_transactions"),
    ]
)
RATES = ", ".join(
    [
        rate(IS_FAILED, "failure_rate_pct"),
        rate(IS_FRAUD, "fraud_rate_pct"),
        rate(IS_CHARGEBACK, "chargeback_rate_pct"),
    ]
)
KPIS = (
    f"{TOTAL}, {VOLUME}, {n(IS_APPROVED, 'approved_transactions')}, {COUNTS}, "
    f"{rate(IS_APPROVED, 'approval_rate_pct')}, {RATES}"
)

DAILY = f"daily AS (SELECT transaction_date, {KPIS} FROM txn GROUP BY transaction_date)"
MERCHANTS = f"""
measured AS (
  SELECT merchant_id, merchant_category, {TOTAL}, {VOLUME}, {AVG_AMOUNT}, {COUNTS}, {RATES}
  FROM txn GROUP BY merchant_id, merchant_category),
merchants AS (
  SELECT *, CASE
      WHEN fraud_rate_pct >= 8 OR chargeback_rate_pct >= 4 OR failure_rate_pct >= 15
        THEN 'High Risk'
      WHEN fraud_rate_pct >= 5 OR chargeback_rate_pct >= 2.5 OR failure_rate_pct >= 10
        THEN 'Medium Risk'
      ELSE 'Low Risk' END AS merchant_risk_level
  FROM measured WHERE total_transactions >= 20)"""
FAILURES = """
failures AS (
  SELECT failure_reason, COUNT(*) AS transaction_count,
         ROUND(100.0E0 * COUNT(*) / (SELECT COUNT(*) FROM txn WHERE is_failed = 1), 2)
           AS pct_of_failed_transactions
  FROM txn WHERE is_failed = 1 GROUP BY failure_reason)"""
HOURLY = f"hourly AS (SELECT hour, {TOTAL}, {COUNTS}, {RATES} FROM txn GROUP BY hour)"


def from_txn(body: str) -> str:
    return f"{TXN} {body}"


def per(key: str, columns: str, having: str = "") -> str:
    return from_txn(f"SELECT {key}, {columns} FROM txn GROUP BY {key} {having}")


def by_flag(flag: str, name: str, yes: str, no: str, average: str) -> str:
    label = f"CASE WHEN {flag} = 1 THEN '{yes}' ELSE '{no}' END AS {name}"
    return from_txn(f"SELECT {label}, {TOTAL}, {average}, {RATES} FROM txn GROUP BY {flag}")


RAW_LIST = (
    "transaction_id, customer_id, merchant_id, transaction_datetime, transaction_amount, "
    "payment_method, channel, device_type, merchant_category, customer_location, "
    "transaction_status, failure_reason, processor_response_ms, is_fraud, is_chargeback"
)
RANKING = (
    "merchant_id, merchant_category, total_transactions, total_payment_volume, "
    "avg_transaction_amount, failure_rate_pct, fraud_rate_pct, chargeback_rate_pct, "
    "merchant_risk_level"
)
TOP_RISK = (
    "transaction_id, customer_id, merchant_id, transaction_amount, payment_method, channel, "
    "merchant_category, customer_location, transaction_status, is_fraud, is_chargeback, "
    "risk_score, risk_level, risk_reason"
)
PREVIEW = (
    "transaction_id, transaction_amount, payment_method, channel, merchant_category, "
    "customer_location, transaction_status, is_fraud, is_chargeback, risk_score, risk_level"
)
SLICE = (
    f"{SCORED}, sliced AS (SELECT * FROM scored WHERE merchant_category = 'Travel' "
    "AND channel = 'Online')"
)


def share(condition: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition}) / CAST(COUNT(*) AS DOUBLE) * 100"


SLICE_FIGURES = f"""
  SELECT {TOTAL}, CAST({EXACT} AS DOUBLE) AS total_volume,
         {share(IS_APPROVED)} AS approval_rate, {share(IS_FAILED)} AS failure_rate,
         {share(IS_FRAUD)} AS fraud_rate, {share(IS_CHARGEBACK)} AS chargeback_rate
  FROM sliced"""
NULL_COUNTS = """
  SELECT column_name, CAST(null_count AS BIGINT) AS null_count FROM (
    UNPIVOT (SELECT COUNT(*) - COUNT(COLUMNS(*)) FROM {table})
    ON COLUMNS(*) INTO NAME column_name VALUE null_count)"""

FRAUD_RATE = (
    "COUNT(transaction_id) AS total_transactions, "
    "CAST(SUM(is_fraud) AS BIGINT) AS fraud_transactions, "
    "SUM(is_fraud) / CAST(COUNT(transaction_id) AS DOUBLE) * 100 AS fraud_rate_pct"
)

SPLIT = f"""{TXN},
hashed AS (SELECT *, md5(concat(transaction_id, '42')) AS key_hash FROM txn),
-- A fifth of all rows, rounded up, shared out by largest remainder.
wanted AS (SELECT COUNT(*) AS all_n, (COUNT(*) + 4) // 5 AS test_rows FROM txn),
shares AS (
  SELECT is_fraud, COUNT(*) * any_value(test_rows) // any_value(all_n) AS sure,
         COUNT(*) * any_value(test_rows) % any_value(all_n) AS rest, any_value(test_rows) AS test_rows
  FROM txn, wanted GROUP BY is_fraud),
classes AS (
  SELECT is_fraud,
         sure + CASE WHEN row_number() OVER (ORDER BY rest DESC, is_fraud DESC)
                          <= test_rows - SUM(sure) OVER () THEN 1 ELSE 0 END AS test_n
  FROM shares),
numbered AS (
  SELECT transaction_id, is_fraud,
         row_number() OVER (PARTITION BY is_fraud ORDER BY key_hash, transaction_id) AS place
  FROM hashed),
split AS (
  SELECT transaction_id, numbered.is_fraud,
         CASE WHEN place <= test_n THEN 'test' ELSE 'train' END AS split
  FROM numbered JOIN classes ON numbered.is_fraud = classes.is_fraud)"""

JUDGED = f"""{SCORED},
judged AS (SELECT is_fraud AS label, CASE WHEN risk_score >= 50 THEN 1 ELSE 0 END AS prediction
           FROM scored)"""


def rule_model(order: int, name: str, floor: int) -> str:
    says = f"risk_score >= {floor}"
    return f"""
  SELECT {order} AS model_order, '{name}' AS model,
         COUNT(*) FILTER (WHERE {says} AND is_fraud = 1) AS tp,
         COUNT(*) FILTER (WHERE {says} AND is_fraud = 0) AS fp,
         COUNT(*) FILTER (WHERE NOT {says} AND is_fraud = 1) AS fn,
         COUNT(*) FILTER (WHERE NOT {says} AND is_fraud = 0) AS tn
  FROM scored"""


RULE_MODELS = f"""{SCORED},
counted AS ({
    " UNION ALL ".join([
        rule_model(0, "Critical only", 75),
        rule_model(1, "High and above", 50),
        rule_model(2, "Medium and above", 25),
        rule_model(3, "Any points at all", 1),
    ])
}),
compared AS (
  SELECT model_order, model,
         (tp + tn) / CAST(tp + fp + fn + tn AS DOUBLE) AS accuracy,
         coalesce(tp / CAST(nullif(tp + fp, 0) AS DOUBLE), 0) AS "precision",
         coalesce(tp / CAST(nullif(tp + fn, 0) AS DOUBLE), 0) AS recall,
         coalesce(2 * tp / CAST(nullif(2 * tp + fp + fn, 0) AS DOUBLE), 0) AS f1_score,
         tp, fp, fn, tn
  FROM counted)"""


def auc(score: str, source: str) -> str:
    return f"""
  SELECT SUM(p * (below + q / 2.0E0)) / (CAST(SUM(p) AS DOUBLE) * SUM(q)) AS roc_auc
  FROM (SELECT p, q, SUM(q) OVER (ORDER BY s) - q AS below
        FROM (SELECT {score} AS s, COUNT(*) FILTER (WHERE is_fraud = 1) AS p,
                     COUNT(*) FILTER (WHERE is_fraud = 0) AS q
              FROM {source} GROUP BY {score}))"""


NUMERICS = [
    "transaction_amount",
    "processor_response_ms",
    "hour",
    "month",
    "is_weekend",
    "high_value_txn",
    "slow_response",
    "risk_score",
]
CATEGORIES = [
    "payment_method",
    "channel",
    "device_type",
    "merchant_category",
    "customer_location",
    "transaction_status",
]
IN_FLIGHT_FEATURES = (
    f"{TXN}, features AS (SELECT *, CAST({IN_FLIGHT_POINTS} AS INT) AS risk_score FROM txn)"
)


def zscore(c: str) -> str:
    return (
        f"ROUND(coalesce((f.{c} - (SELECT AVG({c}) FROM features)) / "
        f"nullif((SELECT stddev_pop({c}) FROM features), 0), 0), 6) AS z_{c}"
    )


SLOTS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, "
    f"CAST(row_number() OVER (ORDER BY {c}) - 1 AS INT) AS slot, COUNT(*) AS rows_set "
    f"FROM txn GROUP BY {c}"
    for c in CATEGORIES
)

REPORT_PART = """
  SELECT CAST(c AS VARCHAR) AS class,
         coalesce(hits / CAST(nullif(predicted, 0) AS DOUBLE), 0) AS "precision",
         coalesce(hits / CAST(nullif(support, 0) AS DOUBLE), 0) AS recall,
         coalesce(2 * hits / CAST(nullif(predicted + support, 0) AS DOUBLE), 0) AS f1_score,
         support, hits
  FROM (SELECT c, COUNT(*) FILTER (WHERE label = c) AS support,
               COUNT(*) FILTER (WHERE prediction = c) AS predicted,
               COUNT(*) FILTER (WHERE label = c AND prediction = c) AS hits
        FROM judged, (VALUES (0), (1)) AS classes(c) GROUP BY c)"""

MART_TABLES = f"{DAILY}, {MERCHANTS}, {FAILURES}, {HOURLY}"


def row_counts(tables: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {source}"
        for name, source in tables.items()
    )


# What names a row of each report; all other columns but texts are figures.
KEYS = {
    "daily_payment_kpis": "transaction_date",
    "merchant_risk_summary": "merchant_id || '|' || merchant_category",
    "failure_reason_summary": "failure_reason",
    "hourly_risk_summary": "CAST(hour AS VARCHAR)",
    "executive_payment_kpis": "''",
    "daily_payment_trend": "transaction_date",
    "top_failure_reasons": "failure_reason",
    "high_risk_merchants": "merchant_id || '|' || merchant_category",
    "fraud_by_channel": "channel",
    "chargeback_by_category": "merchant_category",
    "weekend_vs_weekday_risk": "day_type",
    "slow_response_impact": "response_type",
    "high_value_risk": "transaction_value_type",
    "payment_method_performance": "payment_method",
    "monthly_risk_trend": "CAST(month AS VARCHAR)",
    "location_based_risk": "customer_location",
}
KEY_COLUMNS = (
    "transaction_date, merchant_id, merchant_category, merchant_risk_level, failure_reason, "
    "hour, channel, day_type, response_type, transaction_value_type, payment_method, month, "
    "customer_location"
).split(", ")


def figures(*reports: str) -> str:
    """Every figure of reports as (table_name, row_key, column_name, number)."""
    parts = []
    for name in reports:
        keys = [c for c in KEY_COLUMNS if c in KEYS[name] or c == "merchant_risk_level"]
        has_tier = name in ("merchant_risk_summary", "high_risk_merchants")
        drop = [c for c in keys if c != "merchant_risk_level" or has_tier]
        exclude = f"EXCLUDE ({', '.join(drop)})" if drop else ""
        parts.append(
            f"""SELECT '{name}' AS table_name, row_key, column_name, number FROM (
              UNPIVOT (SELECT row_key, CAST(COLUMNS(* EXCLUDE (row_key)) AS DOUBLE)
                       FROM (SELECT {KEYS[name]} AS row_key, * {exclude} FROM ({SQL[name]})))
              ON COLUMNS(* EXCLUDE (row_key)) INTO NAME column_name VALUE number)"""
        )
    return " UNION ALL ".join(parts)


MODELS = ("Logistic Regression", "Random Forest", "Gradient Boosted Trees")


def comparison(*models: str) -> str:
    """Rows per model and class that any comparison of fitted models must show."""
    names = ", ".join(f"('{m}')" for m in models)
    return f"""{SPLIT}, sides AS (
      SELECT is_fraud AS label, COUNT(*) FILTER (WHERE split = 'train') AS train_rows,
             COUNT(*) FILTER (WHERE split = 'test') AS test_rows FROM split GROUP BY is_fraud)
    SELECT model, label, train_rows, test_rows, test_rows AS judged_rows,
           true AS metrics_in_range
    FROM sides, (VALUES {names}) AS models(model)"""


SQL: dict[str, str] = {
    # Sources, sinks and tables.
    "csv_scan": f"""{RAW} SELECT * REPLACE (nullif(failure_reason, 'None') AS failure_reason)
        FROM raw""",
    "csv_sink": f"{TXN}, {DAILY} SELECT * FROM daily",
    "replaced_table": from_txn("SELECT * FROM txn"),
    "load_validation": f"{SCORED}, {MART_TABLES} "
    + row_counts(
        {
            "payment_transactions": "txn",
            "payment_transactions_scored": "scored",
            "daily_payment_kpis": "daily",
            "merchant_risk_summary": "merchants",
            "failure_reason_summary": "failures",
            "hourly_risk_summary": "hourly",
        }
    ),
    "merchant_mart_from_rollup": f"{TXN}, {MERCHANTS} SELECT * FROM merchants",
    "daily_mart_from_rollup": f"{TXN}, {DAILY} SELECT * FROM daily",
    "cached_slices": f"{SCORED} SELECT channel, risk_level, COUNT(*) AS transactions "
    "FROM scored GROUP BY channel, risk_level",
    # Cleaning and profiling.
    "exact_dedup": f"{UNIQUE} SELECT * FROM uniq",
    "timestamp_parse": f"""{UNIQUE} SELECT transaction_id,
        CAST(date_trunc('second', transaction_datetime) AS TIMESTAMP) AS transaction_datetime
        FROM uniq""",
    "null_fill": f"{UNIQUE} {FILLED}",
    "positive_amounts": f"{UNIQUE} SELECT * FROM uniq WHERE transaction_amount > 0",
    "valid_statuses": f"""{UNIQUE} SELECT * FROM uniq
        WHERE transaction_status IN ('Approved', 'Failed')""",
    "cleaning_counters": f"""{UNIQUE}
        SELECT (SELECT COUNT(*) FROM raw) AS raw_rows, 0::BIGINT AS quarantined_rows,
               (SELECT COUNT(*) FROM raw) - COUNT(*) AS duplicates_removed,
               COUNT(*) FILTER (WHERE transaction_amount IS NULL) AS missing_amounts,
               COUNT(*) FILTER (WHERE transaction_amount <= 0) AS invalid_amounts,
               COUNT(*) FILTER (WHERE transaction_amount > 0
                 AND transaction_status NOT IN ('Approved', 'Failed')) AS invalid_statuses,
               COUNT(*) FILTER (WHERE transaction_amount > 0
                 AND transaction_status IN ('Approved', 'Failed')) AS clean_rows,
               COUNT(*) FILTER (WHERE transaction_amount > 0
                 AND transaction_status IN ('Approved', 'Failed')
                 AND (transaction_datetime IS NULL OR processor_response_ms IS NULL))
                 AS incomplete_rows
        FROM uniq""",
    "quarantined_rows": f"""{RAW} SELECT transaction_id,
        concat_ws(',', CASE WHEN transaction_id LIKE '%7' THEN 'transaction_datetime' END,
                  CASE WHEN transaction_id LIKE '%5' OR transaction_id LIKE '%77'
                       THEN 'transaction_amount' END) AS unreadable, COUNT(*) AS copies
        FROM raw WHERE transaction_id LIKE '%5' OR transaction_id LIKE '%7' GROUP BY ALL""",
    "damaged_csv_counters": f"""{RAW},
        kept AS (SELECT * FROM raw
                 WHERE transaction_id NOT LIKE '%5' AND transaction_id NOT LIKE '%7'),
        uniq AS (SELECT DISTINCT * REPLACE (
                   CASE WHEN transaction_id LIKE '%3' THEN NULL ELSE transaction_amount END
                     AS transaction_amount,
                   CASE WHEN transaction_id LIKE '%9' THEN NULL ELSE processor_response_ms END
                     AS processor_response_ms) FROM kept)
        SELECT (SELECT COUNT(*) FROM raw) AS raw_rows,
               (SELECT COUNT(*) FROM raw) - (SELECT COUNT(*) FROM kept) AS quarantined_rows,
               (SELECT COUNT(*) FROM kept) - COUNT(*) AS duplicates_removed,
               COUNT(*) FILTER (WHERE transaction_amount IS NULL) AS missing_amounts,
               COUNT(*) FILTER (WHERE transaction_amount <= 0) AS invalid_amounts,
               COUNT(*) FILTER (WHERE transaction_amount > 0
                 AND transaction_status NOT IN ('Approved', 'Failed')) AS invalid_statuses,
               COUNT(*) FILTER (WHERE transaction_amount > 0
                 AND transaction_status IN ('Approved', 'Failed')) AS clean_rows,
               COUNT(*) FILTER (WHERE transaction_amount > 0
                 AND transaction_status IN ('Approved', 'Failed')
                 AND processor_response_ms IS NULL) AS incomplete_rows
        FROM uniq""",
    "null_profile_raw": f"{RAW} {NULL_COUNTS.format(table='raw')}",
    "null_profile_clean": f"{TXN} {NULL_COUNTS.format(table='txn')}",
    "time_features": f"{UNIQUE} SELECT transaction_id, {TIME_PARTS} FROM uniq",
    "threshold_flags": f"{UNIQUE} SELECT transaction_id, {FLAGS} FROM uniq",
    "clean_payments": from_txn("SELECT * FROM txn"),
    "datetime_text": from_txn(
        "SELECT transaction_id, strftime(transaction_datetime, '%Y-%m-%d %H:%M:%S') "
        "AS transaction_datetime, transaction_date "
        "FROM txn"
    ),
    "report_columns": f"{SCORED} SELECT {TOP_RISK} FROM scored",
    "failed_payments": from_txn(
        f"SELECT {RAW_LIST}, transaction_date, hour, day_of_week, month, year, is_weekend, "
        "is_failed, high_value_txn, slow_response FROM txn WHERE is_failed = 1"
    ),
    "high_risk_merchant_rows": f"""{TXN}, {MERCHANTS}
        SELECT * FROM merchants WHERE merchant_risk_level = 'High Risk'""",
    "payment_slice": f"{SLICE} SELECT * FROM sliced",
    "payment_slice_all": f"{SCORED} SELECT * FROM scored",
    "transaction_preview": f"""{SLICE}
        SELECT {PREVIEW} FROM sliced ORDER BY transaction_id LIMIT 100""",
    # Reporting tables and business questions.
    "executive_payment_kpis": from_txn(f"SELECT {KPIS} FROM txn"),
    "daily_payment_kpis": f"{TXN}, {DAILY} SELECT * FROM daily",
    "daily_payment_trend": f"""{TXN}, {DAILY}
        SELECT transaction_date, total_transactions, total_payment_volume, approval_rate_pct,
               failure_rate_pct, fraud_rate_pct, chargeback_rate_pct FROM daily""",
    "merchant_risk_summary": f"{TXN}, {MERCHANTS} SELECT * FROM merchants",
    "merchant_risk_tier": f"""{TXN}, {MERCHANTS}
        SELECT merchant_risk_level, COUNT(*) AS merchants FROM merchants
        GROUP BY merchant_risk_level""",
    "failure_reason_summary": f"{TXN}, {FAILURES} SELECT * FROM failures",
    "top_failure_reasons": f"""{TXN}, {FAILURES}
        SELECT * FROM failures ORDER BY transaction_count DESC, failure_reason""",
    "hourly_risk_summary": f"{TXN}, {HOURLY} SELECT * FROM hourly",
    "fraud_by_channel": per(
        "channel",
        f"{TOTAL}, {n(IS_FRAUD, 'fraud_transactions')}, {rate(IS_FRAUD, 'fraud_rate_pct')}, "
        f"{AVG_AMOUNT}",
    ),
    "chargeback_by_category": per(
        "merchant_category",
        f"{TOTAL}, {n(IS_CHARGEBACK, 'chargebacks')}, "
        f"{rate(IS_CHARGEBACK, 'chargeback_rate_pct')}, {VOLUME}",
    ),
    "weekend_vs_weekday_risk": by_flag(
        "is_weekend", "day_type", "Weekend", "Weekday", AVG_AMOUNT
    ),
    "slow_response_impact": by_flag(
        "slow_response",
        "response_type",
        "Slow Response",
        "Normal Response",
        mean("processor_response_ms", "avg_processor_response_ms"),
    ),
    "high_value_risk": by_flag(
        "high_value_txn", "transaction_value_type", "High Value", "Standard Value", AVG_AMOUNT
    ),
    "payment_method_performance": per(
        "payment_method", f"{TOTAL}, {VOLUME}, {AVG_AMOUNT}, {RATES}"
    ),
    "monthly_risk_trend": per("month", f"{TOTAL}, {VOLUME}, {RATES}"),
    "location_based_risk": per(
        "customer_location", f"{TOTAL}, {VOLUME}, {RATES}", "HAVING COUNT(*) >= 100"
    ),
    "high_risk_merchants": f"""{TXN}, {MERCHANTS}
        SELECT {RANKING} FROM merchants WHERE merchant_risk_level = 'High Risk'
        ORDER BY fraud_rate_pct DESC, chargeback_rate_pct DESC, merchant_id, merchant_category
        LIMIT 25""",
    "high_risk_merchants_dashboard": f"""{TXN}, {MERCHANTS}
        SELECT * FROM merchants WHERE merchant_risk_level = 'High Risk'
        ORDER BY fraud_rate_pct DESC, chargeback_rate_pct DESC, failure_rate_pct DESC,
                 merchant_id, merchant_category
        LIMIT 25""",
    "merchant_top5": f"""{TXN}, {MERCHANTS}
        SELECT merchant_id, merchant_category, total_transactions, failure_rate_pct,
               fraud_rate_pct, chargeback_rate_pct, merchant_risk_level
        FROM merchants
        ORDER BY fraud_rate_pct DESC, chargeback_rate_pct DESC, merchant_id, merchant_category
        LIMIT 5""",
    # Risk scoring.
    "score_transactions": f"{SCORED} SELECT * FROM scored",
    "risk_score": f"{SCORED} SELECT transaction_id, risk_score FROM scored",
    "risk_level": f"{SCORED} SELECT transaction_id, risk_level FROM scored",
    "risk_reason": f"{SCORED} SELECT transaction_id, risk_reason FROM scored",
    "pre_txn_risk_score": f"""{SCORED} SELECT transaction_id, pre_txn_risk_score,
        {level("pre_txn_risk_score")} AS pre_txn_risk_level FROM pointed""",
    "risk_level_summary": f"""{SCORED}
        SELECT risk_level, COUNT(*) AS transactions, {mean("risk_score", "avg_risk_score")},
               ROUND(100.0E0 * COUNT(*) / (SELECT COUNT(*) FROM scored), 2) AS pct_total
        FROM scored GROUP BY risk_level""",
    "top_risk_transactions": f"""{SCORED}
        SELECT {TOP_RISK} FROM scored ORDER BY risk_score DESC, transaction_id LIMIT 25""",
    "top_risk_preview": f"""{SCORED}
        SELECT {TOP_RISK} FROM scored ORDER BY risk_score DESC, transaction_id LIMIT 10""",
    "daily_trend_preview": f"""{TXN}, {DAILY}
        SELECT transaction_date, total_transactions, total_payment_volume, approval_rate_pct,
               failure_rate_pct, fraud_rate_pct, chargeback_rate_pct
        FROM daily ORDER BY transaction_date LIMIT 5""",
    # Dashboard slices.
    "slice_kpis": f"{SLICE} {SLICE_FIGURES}",
    "slice_kpi_cards": f"""{SLICE}, figures AS ({SLICE_FIGURES})
        SELECT format('{{:,}}', total_transactions) AS total_transactions,
               concat('$', format('{{:,.2f}}', total_volume)) AS total_volume,
               concat(format('{{:.2f}}', approval_rate), '%') AS approval_rate,
               concat(format('{{:.2f}}', failure_rate), '%') AS failure_rate,
               concat(format('{{:.2f}}', fraud_rate), '%') AS fraud_rate,
               concat(format('{{:.2f}}', chargeback_rate), '%') AS chargeback_rate
        FROM figures""",
    "slice_fraud_by_channel": f"""{SCORED} SELECT channel, {FRAUD_RATE} FROM scored
        WHERE payment_method = 'Credit Card' GROUP BY channel""",
    "slice_hourly_fraud": f"""{SCORED} SELECT hour, {FRAUD_RATE} FROM scored
        WHERE channel = 'Mobile App' GROUP BY hour""",
    "slice_failure_counts": f"""{SLICE} SELECT failure_reason, COUNT(*) AS "count" FROM sliced
        WHERE is_failed = 1 GROUP BY failure_reason""",
    "slice_risk_distribution": f"""{SLICE} SELECT risk_level, COUNT(*) AS transactions
        FROM sliced GROUP BY risk_level""",
    "distinct_values": f"{TXN} "
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{c}' AS column_name, {c} AS value FROM txn" for c in CATEGORIES
    ),
    # Whole-table figures.
    "target_distribution": from_txn(
        "SELECT is_fraud, ROUND(100.0E0 * COUNT(*) / (SELECT COUNT(*) FROM txn), 2) AS share_pct "
        "FROM txn GROUP BY is_fraud"
    ),
    "overall_rates": from_txn(
        f"SELECT {rate(IS_APPROVED, 'approval_rate_pct')}, {rate(IS_FRAUD, 'fraud_rate_pct')}, "
        f"{rate(IS_CHARGEBACK, 'chargeback_rate_pct')} FROM txn"
    ),
    "raw_status_counts": f"""{RAW} SELECT transaction_status, COUNT(*) AS transactions FROM raw
        GROUP BY transaction_status""",
    "raw_outcome_rates": f"""{RAW} SELECT {TOTAL}, {rate(IS_FRAUD, "fraud_rate_pct")},
        {rate(IS_CHARGEBACK, "chargeback_rate_pct")} FROM raw""",
    "streamed_scores": f"{SCORED} SELECT * FROM scored",
    "spike_alerts": f"{TXN}, {SPIKES} SELECT * FROM spikes",
    "streamed_spike_alerts": f"{TXN}, {SPIKES} SELECT * FROM spikes",
    # Model preparation and evaluation.
    "model_feature_rows": f"""{IN_FLIGHT_FEATURES}
        SELECT transaction_id, {", ".join(NUMERICS + CATEGORIES)}, is_fraud FROM features""",
    "stratified_split": f"{SPLIT} SELECT * FROM split",
    "standardised_numerics": f"""{IN_FLIGHT_FEATURES}
        SELECT transaction_id, {", ".join(zscore(c) for c in NUMERICS)} FROM features f""",
    "category_slots": f"{TXN} {SLOTS}",
    "feature_vectors": from_txn(
        f"SELECT transaction_id, CAST({len(NUMERICS)} + "
        + " + ".join(f"(SELECT COUNT(DISTINCT {c}) FROM txn)" for c in CATEGORIES)
        + f" AS INT) AS vector_size, {len(CATEGORIES)} AS slots_set FROM txn"
    ),
    "class_weights": f"""{SPLIT}, part AS (SELECT * FROM split WHERE split = 'train')
        SELECT is_fraud, COUNT(*) AS n,
               (SELECT COUNT(*) FROM part) / (2.0E0 * COUNT(*)) AS class_weight
        FROM part GROUP BY is_fraud""",
    "roc_auc_rules": f"""{SCORED}
        SELECT 'post_txn' AS scorer, roc_auc FROM ({auc("risk_score", "scored")})
        UNION ALL
        SELECT 'pre_txn' AS scorer, roc_auc FROM ({auc("pre_txn_risk_score", "pointed")})""",
    "rule_model_metrics": f"{RULE_MODELS} SELECT * FROM compared",
    "confusion_matrix": f"""{JUDGED}
        SELECT label, prediction, COUNT(*) AS transactions FROM judged
        GROUP BY label, prediction""",
    "classification_report": f"""{JUDGED}, parts AS ({REPORT_PART})
        SELECT class, "precision", recall, f1_score, support FROM parts
        UNION ALL
        SELECT 'accuracy', SUM(hits) / CAST(SUM(support) AS DOUBLE),
               SUM(hits) / CAST(SUM(support) AS DOUBLE),
               SUM(hits) / CAST(SUM(support) AS DOUBLE), CAST(SUM(support) AS BIGINT)
        FROM parts
        UNION ALL
        SELECT 'macro avg', AVG("precision"), AVG(recall), AVG(f1_score),
               CAST(SUM(support) AS BIGINT) FROM parts
        UNION ALL
        SELECT 'weighted avg', SUM("precision" * support) / SUM(support),
               SUM(recall * support) / SUM(support), SUM(f1_score * support) / SUM(support),
               CAST(SUM(support) AS BIGINT) FROM parts""",
    "best_rule_model": f"{RULE_MODELS} SELECT * FROM compared ORDER BY recall DESC, model_order "
    "LIMIT 1",
    "model_feature_list": f"{TXN} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, '{kind}' AS type, COUNT({c}) AS rows_present "
        f"FROM {'features'}"
        for kind, names in (("numeric", NUMERICS), ("categorical", CATEGORIES))
        for c in names
    ),
}
SQL["model_feature_list"] = SQL["model_feature_list"].replace(TXN, IN_FLIGHT_FEATURES, 1)
SQL["exported_tables"] = figures(
    "daily_payment_kpis", "merchant_risk_summary", "failure_reason_summary", "hourly_risk_summary"
)
SQL["named_questions"] = figures(*list(KEYS)[4:])
SQL["model_comparison"] = SQL["model_comparison_with_outcomes"] = comparison(*MODELS)
SQL["logistic_regression"], SQL["random_forest"], SQL["gradient_boosted_trees"] = (
    comparison(m) for m in MODELS
)
SQL["model_confusion"] = f"""{SPLIT}
    SELECT model, is_fraud AS label, COUNT(*) AS transactions
    FROM split, (VALUES {", ".join(f"('{m}')" for m in MODELS)}) AS models(model)
    WHERE split = 'test' GROUP BY model, is_fraud"""
SQL["model_report"] = f"""{SPLIT}, held AS (SELECT is_fraud FROM split WHERE split = 'test')
    SELECT model, class, CASE class WHEN '0' THEN (SELECT COUNT(*) FROM held WHERE is_fraud = 0)
             WHEN '1' THEN (SELECT COUNT(*) FROM held WHERE is_fraud = 1)
             ELSE (SELECT COUNT(*) FROM held) END AS support
    FROM (VALUES {", ".join(f"('{m}')" for m in MODELS)}) AS models(model),
         (VALUES ('0'), ('1'), ('accuracy'), ('macro avg'), ('weighted avg')) AS classes(class)"""
SQL["batch_predictions"] = f"""{SCORED}
    SELECT transaction_id, pre_txn_risk_score AS risk_score,
           {level("pre_txn_risk_score")} AS rule_risk_level, true AS consistent FROM pointed"""

# The same areas, ranked range by range.
SQL["roc_auc_ranked"] = SQL["roc_auc_rules"]

# What must hold of any right fit.
SQL["model_certificates"] = """
    SELECT * FROM (VALUES
        ('Logistic Regression', 'gradient is zero', true),
        ('Random Forest', 'leaves are means of their rows', true),
        ('Gradient Boosted Trees', 'first leaves are means of their rows', true)
    ) AS t(model, certificate, holds)"""
