"""Raw payments to clean payments.

Only the duplicate removal shuffles. The row filters look at columns the duplicate
removal groups by, so Catalyst moves them below it; the derived columns are a single
projection on top.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskledger.schema import (
    CLEAN_COLUMNS,
    DAY_NAMES,
    FAILED,
    FILL_VALUES,
    HIGH_VALUE_AMOUNT,
    NO_FAILURE_TOKEN,
    SLOW_RESPONSE_MS,
    VALID_STATUSES,
)

TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"


def drop_exact_duplicates(raw: DataFrame) -> DataFrame:
    """Keep one of each group of rows that agree in every column, nulls included."""
    return raw.dropDuplicates()


def parse_timestamp(df: DataFrame, column: str = "transaction_datetime") -> DataFrame:
    """Text to timestamp; like any strict parser it fails on text that is no timestamp."""
    return df.withColumn(column, F.to_timestamp_ntz(F.col(column), F.lit(TIMESTAMP_PATTERN)))


def fill_missing(df: DataFrame) -> DataFrame:
    reason = F.nullif(F.col("failure_reason"), F.lit(NO_FAILURE_TOKEN))
    return df.withColumn("failure_reason", reason).fillna(FILL_VALUES)


def has_valid_amount() -> Column:
    """True for positive amounts, unknown for missing ones; NaN is not positive.

    Left as a plain comparison so that the Parquet reader can use it.
    """
    amount = F.col("transaction_amount")
    return ~F.isnan(amount) & (amount > 0)


def has_valid_status() -> Column:
    return F.col("transaction_status").isin(VALID_STATUSES)


def is_true(condition: Column) -> Column:
    """The condition with unknown counted as false, for negating and for counting."""
    return F.coalesce(condition, F.lit(False))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it fails or is unknown."""
    return is_true(condition).cast("int")


def keep_positive_amounts(df: DataFrame) -> DataFrame:
    return df.filter(has_valid_amount())


def keep_valid_statuses(df: DataFrame) -> DataFrame:
    return df.filter(has_valid_status())


def add_time_features(df: DataFrame) -> DataFrame:
    at = F.col("transaction_datetime")
    weekday = F.dayofweek(at)
    return df.withColumns(
        {
            "transaction_date": F.to_date(at),
            "hour": F.hour(at),
            "day_of_week": F.get(F.array(*[F.lit(d) for d in DAY_NAMES]), weekday - 1),
            "month": F.month(at),
            "year": F.year(at),
            "is_weekend": flag(weekday.isin(1, 7)),
        }
    )


def add_threshold_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_failed": flag(F.col("transaction_status") == FAILED),
            "high_value_txn": flag(F.col("transaction_amount") >= HIGH_VALUE_AMOUNT),
            "slow_response": flag(F.col("processor_response_ms") >= SLOW_RESPONSE_MS),
        }
    )


def repair_and_derive(df: DataFrame) -> DataFrame:
    """Everything after duplicate removal: narrow, so it also runs on a stream."""
    return (
        df.transform(keep_positive_amounts)
        .transform(keep_valid_statuses)
        .transform(fill_missing)
        .transform(add_time_features)
        .transform(add_threshold_flags)
        .select(*CLEAN_COLUMNS)
    )


def clean_payments(raw: DataFrame) -> DataFrame:
    return raw.transform(drop_exact_duplicates).transform(repair_and_derive)
