import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskledger.operators import cleaning, quality
from riskledger.schema import CLEAN_COLUMNS


def values(df, column):
    return [r[0] for r in df.orderBy("transaction_id").select(column).collect()]


def test_duplicates_agree_in_every_column_including_nulls(payments):
    same = {"transaction_id": "A", "merchant_category": None}
    df = payments(same, same, {**same, "channel": "Online"}, {"transaction_id": "B"})
    assert cleaning.drop_exact_duplicates(df).count() == 3


def test_a_third_of_all_rows_being_copies_collapses_before_the_shuffle(payments):
    df = payments(*[{"transaction_id": "HOT"}] * 40, *[{} for _ in range(80)])
    unique = cleaning.drop_exact_duplicates(df.repartition(4))
    assert unique.count() == 81


def test_missing_values_get_their_fill(payments):
    df = cleaning.fill_missing(
        payments(
            {"merchant_category": None, "customer_location": None},
            {"failure_reason": "Expired Card"},
            {"failure_reason": None},
        )
    )
    assert values(df, "merchant_category") == ["Other", "Retail", "Retail"]
    assert values(df, "customer_location") == ["Unknown", "TX", "TX"]
    assert values(df, "failure_reason") == ["Not Applicable", "Expired Card", "Not Applicable"]


def test_only_positive_amounts_stay(payments):
    amounts = [-1.0, 0.0, 0.01, None, float("nan")]
    df = payments(*[{"transaction_amount": a} for a in amounts])
    assert values(cleaning.keep_positive_amounts(df), "transaction_amount") == [0.01]


def test_only_known_statuses_stay(payments):
    statuses = ["Approved", "Failed", "Pending", None]
    df = payments(*[{"transaction_status": s} for s in statuses])
    assert values(cleaning.keep_valid_statuses(df), "transaction_status") == statuses[:2]


def test_counters_follow_the_order_of_the_steps(payments):
    df = payments(
        {"transaction_id": "A"},
        {"transaction_id": "A"},
        {"transaction_amount": 0.0, "transaction_status": "Pending"},
        {"transaction_amount": None},
        {"transaction_amount": float("nan")},
        {"transaction_status": "Pending"},
        {"transaction_status": None},
    )
    row = quality.cleaning_counters(df).first().asDict()
    assert row == {
        "raw_rows": 7,
        "quarantined_rows": 0,
        "duplicates_removed": 1,
        "missing_amounts": 2,
        "invalid_amounts": 1,
        "invalid_statuses": 2,
        "clean_rows": 1,
        "incomplete_rows": 0,
    }
    removed = ("quarantined_rows", "duplicates_removed", "missing_amounts", "invalid_amounts",
               "invalid_statuses")
    assert row["raw_rows"] == row["clean_rows"] + sum(row[c] for c in removed)
    assert cleaning.clean_payments(df).count() == row["clean_rows"]


@pytest.mark.parametrize(
    ("day", "name", "weekend"),
    [(5, "Friday", 0), (6, "Saturday", 1), (7, "Sunday", 1), (8, "Monday", 0)],
)
def test_day_name_and_weekend_flag(clean, day, name, weekend):
    df = clean(
        {"transaction_datetime": dt.datetime(2024, 1, day, 0, 0, 0)},
        {"transaction_datetime": dt.datetime(2024, 1, day, 23, 59, 59)},
    )
    assert {r[0] for r in df.select("day_of_week").collect()} == {name}
    assert {r[0] for r in df.select("is_weekend").collect()} == {weekend}
    assert values(df, "hour") == [0, 23]
    assert values(df, "transaction_date") == [dt.date(2024, 1, day)] * 2


def test_time_parts_do_not_depend_on_the_session_zone(spark, clean):
    df = clean({"transaction_datetime": dt.datetime(2024, 3, 10, 2, 30)})
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select("hour", "day_of_week", "transaction_date").first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (2, "Sunday", dt.date(2024, 3, 10))


def test_thresholds_include_their_boundary(clean):
    df = clean(
        {"transaction_amount": 499.99, "processor_response_ms": 899},
        {"transaction_amount": 500.0, "processor_response_ms": 900},
        {"transaction_status": "Failed", "processor_response_ms": None},
    )
    assert values(df, "high_value_txn") == [0, 1, 0]
    assert values(df, "slow_response") == [0, 1, 0]
    assert values(df, "is_failed") == [0, 0, 1]


def test_flags_of_unknown_values_are_zero(clean):
    row = clean({"transaction_datetime": None, "processor_response_ms": None}).first()
    assert (row.is_weekend, row.slow_response, row.day_of_week) == (0, 0, None)


def test_clean_columns_in_order(clean):
    assert clean({}).columns == CLEAN_COLUMNS


def test_null_profile_counts_each_column(payments):
    df = payments({"channel": None}, {"channel": None, "merchant_category": None})
    counts = dict(quality.null_profile(df).collect())
    assert counts["channel"] == 2
    assert counts["merchant_category"] == 1
    assert counts["is_fraud"] == 0


def test_text_that_is_no_timestamp_fails(spark):
    df = spark.createDataFrame([("2024-13-01 00:00:00",)], "transaction_datetime STRING")
    with pytest.raises(Exception, match="CANNOT_PARSE_TIMESTAMP"):
        cleaning.parse_timestamp(df).collect()


def test_row_filters_run_below_the_duplicate_removal_and_reach_parquet(spark, payments, tmp_path):
    payments({}, {"transaction_amount": 0.0}).write.parquet(str(tmp_path / "raw"))
    df = cleaning.clean_payments(spark.read.parquet(str(tmp_path / "raw")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters") :].split("ReadSchema")[0]
    assert "GreaterThan(transaction_amount,0.0)" in pushed
    assert "transaction_status" in pushed
    assert plan.count("Exchange hashpartitioning") == 1
    assert df.filter(F.col("transaction_amount") <= 0).count() == 0


@pytest.mark.parametrize("rows", [0, 1, 40])
def test_counters_from_the_stored_rows_agree(spark, payments, rows):
    kinds = [
        {},
        {"transaction_amount": None},
        {"transaction_amount": float("nan"), "transaction_status": "Pending"},
        {"transaction_amount": -1.0},
        {"transaction_status": "Pending"},
        {"processor_response_ms": None},
        {"transaction_datetime": None},
    ]
    df = payments(*[{"transaction_id": str(i % 17), **kinds[i % 7]} for i in range(rows)] * 2) if rows else payments({}).limit(0)
    clean = cleaning.clean_payments(df)
    got = quality.cleaning_counters(df, df.limit(1), clean).collect()
    assert got == quality.cleaning_counters(df, df.limit(1)).collect()
    assert got[0].duplicates_removed >= rows


def test_stored_rows_save_the_shuffle_of_all_rows(payments):
    df = payments({}, {"transaction_amount": None})
    plan = quality.cleaning_counters(df, None, cleaning.clean_payments(df))
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    grouped = text[text.index("Aggregate [transaction_id") :]
    assert grouped.splitlines()[1].strip().lstrip("+-: ").startswith(("Filter", "Project"))
