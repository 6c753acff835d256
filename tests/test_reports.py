import pytest
from pyspark.sql import functions as F

from riskledger.operators import merchants, quality, scoring, slices
from riskledger.plans.marts import MARTS
from riskledger.plans.questions import QUESTIONS, RISK_LEVELS
from riskledger.plans.rollup import DIMENSIONS, GRAINS, at_grain, grouping_number, kpi_rollup
from riskledger.registry import QUERIES, scored, txn
from riskledger.schema import DAILY, FAILURE, HOURLY, MERCHANT


@pytest.fixture(scope="module")
def small(spark, sf_dir):
    df = scored(spark, sf_dir).cache()
    df.count()
    yield df
    df.unpersist()


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize(
    ("fraud", "chargeback", "failure", "tier"),
    [
        (8.0, 0.0, 0.0, "High Risk"),
        (7.99, 0.0, 0.0, "Medium Risk"),
        (5.0, 0.0, 0.0, "Medium Risk"),
        (4.99, 0.0, 0.0, "Low Risk"),
        (0.0, 4.0, 0.0, "High Risk"),
        (0.0, 3.99, 0.0, "Medium Risk"),
        (0.0, 2.5, 0.0, "Medium Risk"),
        (0.0, 2.49, 0.0, "Low Risk"),
        (0.0, 0.0, 15.0, "High Risk"),
        (0.0, 0.0, 14.99, "Medium Risk"),
        (0.0, 0.0, 10.0, "Medium Risk"),
        (0.0, 0.0, 9.99, "Low Risk"),
    ],
)
def test_merchant_tier_boundaries(spark, fraud, chargeback, failure, tier):
    df = spark.createDataFrame(
        [(fraud, chargeback, failure)],
        "fraud_rate_pct DOUBLE, chargeback_rate_pct DOUBLE, failure_rate_pct DOUBLE",
    )
    assert df.select(merchants.merchant_risk_tier()).first()[0] == tier


def test_merchants_need_twenty_payments(clean):
    df = clean(*[{"merchant_id": "A"}] * 19, *[{"merchant_id": "B"}] * 20)
    assert [r.merchant_id for r in MARTS[MERCHANT].over_payments(df).collect()] == ["B"]


def test_locations_need_a_hundred_payments(clean):
    df = clean(*[{"customer_location": "TX"}] * 99, *[{"customer_location": "NY"}] * 100)
    answer = QUESTIONS["location_based_risk"].over_payments(df).collect()
    assert [r.customer_location for r in answer] == ["NY"]


def test_tier_uses_the_rounded_rate(clean):
    # 15 of 188 is 7.978...%, 8.0 only after rounding would be wrong; 2 of 25 is exactly 8.
    df = clean(
        *[{"merchant_id": "A", "is_fraud": int(i < 15)} for i in range(188)],
        *[{"merchant_id": "B", "is_fraud": int(i < 2)} for i in range(25)],
    )
    tiers = {
        r.merchant_id: (r.fraud_rate_pct, r.merchant_risk_level)
        for r in MARTS[MERCHANT].over_payments(df).collect()
    }
    assert tiers == {"A": (7.98, "Medium Risk"), "B": (8.0, "High Risk")}


def test_money_sums_are_exact_and_halves_round_up(clean):
    df = clean(*[{"transaction_amount": a} for a in (0.1, 0.2, 0.3, 0.02)])
    answer = QUESTIONS["payment_method_performance"].over_payments(df).first()
    assert answer.total_payment_volume == 0.62
    assert answer.avg_transaction_amount == 0.16  # 0.155


def test_totals_agree_between_reports(small):
    overall = QUESTIONS["executive_payment_kpis"].over_payments(small).first()
    counts = ("total_transactions", "failed_transactions", "fraud_transactions")
    for name in (DAILY, HOURLY):
        sums = MARTS[name].over_payments(small).agg(*[F.sum(c).alias(c) for c in counts]).first()
        assert [sums[c] for c in counts] == [overall[c] for c in counts]
    daily_volume = MARTS[DAILY].over_payments(small).agg(F.sum("total_payment_volume")).first()[0]
    assert daily_volume == pytest.approx(overall.total_payment_volume)
    for name in (
        "monthly_risk_trend",
        "chargeback_by_category",
        "payment_method_performance",
        "fraud_by_channel",
        "weekend_vs_weekday_risk",
        "slow_response_impact",
        "high_value_risk",
    ):
        answer = QUESTIONS[name].over_payments(small)
        assert answer.agg(F.sum("total_transactions")).first()[0] == overall.total_transactions
    failures = MARTS[FAILURE].over_payments(small).agg(F.sum("transaction_count")).first()[0]
    assert failures == overall.failed_transactions
    levels = scoring.risk_level_summary(small).agg(F.sum("transactions")).first()[0]
    assert levels == overall.total_transactions
    assert overall.approved_transactions + overall.failed_transactions == small.count()


def test_rollup_gives_the_same_reports(small):
    rollup = kpi_rollup(small).cache()
    reports = {**MARTS, **QUESTIONS, "risk_level_summary": RISK_LEVELS}
    for name, report in reports.items():
        if name == "risk_level_summary":
            direct = scoring.risk_level_summary(small)
        else:
            direct = report.over_payments(small)
        assert rows(report.over_rollup(rollup)) == rows(direct), name
    rollup.unpersist()


def test_grains_are_told_apart():
    numbers = [grouping_number(keys, DIMENSIONS) for keys in GRAINS.values()]
    assert len(set(numbers)) == len(GRAINS)


def test_rollup_keeps_unknown_keys_apart_from_other_grains(clean):
    df = scoring.score_transactions(clean({"channel": None}, {"channel": "Online"}))
    channels = at_grain(kpi_rollup(df), "channel").collect()
    assert {(r.channel, r.total_transactions) for r in channels} == {(None, 1), ("Online", 1)}


def test_share_of_failures_reuses_the_aggregate(spark, sf_dir):
    df = MARTS[FAILURE].over_payments(txn(spark, sf_dir))
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()


def test_slice_filters_combine_and_all_means_no_filter(small):
    everything = slices.slice_payments(small, "All", "All", "All")
    assert everything.count() == small.count()
    chosen = slices.slice_payments(small, "Travel", "Online", "Credit Card")
    expected = small.filter(
        "merchant_category = 'Travel' AND channel = 'Online' AND payment_method = 'Credit Card'"
    )
    assert chosen.count() == expected.count() > 0


def test_empty_slice_has_no_rates(small):
    row = slices.slice_kpis(slices.slice_payments(small, "No such category")).first()
    assert tuple(row) == (0, 0.0, None, None, None, None)


def test_slice_groups_leave_out_missing_keys(clean):
    df = scoring.score_transactions(clean({"channel": None}, {"channel": "Online"}))
    assert [r.channel for r in slices.slice_fraud_by_channel(df).collect()] == ["Online"]


def test_cards_are_text(clean):
    df = scoring.score_transactions(clean(*[{"transaction_amount": 1234.5}] * 3))
    card = slices.slice_kpi_cards(df).first()
    assert card.total_transactions == "3"
    assert card.total_volume == "$3,703.50"
    assert card.approval_rate == "100.00%"


def test_flag_groups_without_a_value_stay_their_own_row(spark, clean):
    df = clean({}, {}).withColumn("is_weekend", F.lit(None).cast("int")).unionByName(clean({}))
    answer = QUESTIONS["weekend_vs_weekday_risk"].over_payments(df)
    assert sorted((r.day_type, r.total_transactions) for r in answer.collect()) == [
        ("Weekday", 1),
        ("Weekday", 2),
    ]


def test_options_are_sorted_and_distinct(small):
    options = quality.distinct_values(small, ["channel", "payment_method"]).collect()
    assert [r.value for r in options if r.column_name == "channel"] == [
        "In-Store",
        "Mobile App",
        "Online",
    ]


def test_hot_key_is_preaggregated(spark, clean):
    df = clean(*[{"merchant_id": "HOT"}] * 60, *[{"merchant_id": f"M{i}"} for i in range(60)])
    report = MARTS[MERCHANT].over_payments(df.repartition(4))
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert [r.total_transactions for r in report.collect()] == [60]


def test_a_single_report_reads_only_its_columns(spark, small, tmp_path):
    small.write.parquet(str(tmp_path / "scored"))
    stored = spark.read.parquet(str(tmp_path / "scored"))
    plan = QUESTIONS["fraud_by_channel"].over_payments(stored)._jdf.queryExecution()
    text = plan.executedPlan().toString()
    schema = text[text.index("ReadSchema") :].split("\n")[0]
    assert schema == "ReadSchema: struct<transaction_amount:double,channel:string,is_fraud:int>"
    sliced = slices.slice_kpis(slices.slice_payments(stored, channel="Online"))
    assert "EqualTo(channel,Online)" in sliced._jdf.queryExecution().executedPlan().toString()


def test_top_merchants_from_source(spark):
    top = QUERIES["merchant_top5"](spark, "/root/testdata/sf0.01").collect()
    rates = [(r.fraud_rate_pct, r.chargeback_rate_pct) for r in top]
    assert len(top) == 5
    assert rates == sorted(rates, reverse=True)


def test_no_query_uses_a_cartesian_product_or_python(spark, sf_dir):
    eager = {
        "csv_scan", "csv_sink", "replaced_table", "load_validation", "exported_tables",
        "named_questions", "model_comparison", "model_comparison_with_outcomes",
        "batch_predictions", "streamed_scores", "standardised_numerics", "category_slots",
        "feature_vectors", "logistic_regression", "random_forest", "gradient_boosted_trees",
        "model_confusion", "model_report", "quarantined_rows", "damaged_csv_counters",
        "cached_slices", "fitted_metrics", "fitted_confusion", "fitted_report", "fitted_predictions",
        "model_parameters", "table_predictions", "model_certificates", "second_order_boosting",
        "streamed_spike_alerts",
    }
    for name, query in QUERIES.items():
        if name in eager:
            continue
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan, name
        assert "Python" not in plan, name


def test_clean_totals_at_known_scale(spark, sf_dir):
    row = txn(spark, sf_dir).agg(F.count("*"), F.sum("is_fraud"), F.sum("is_failed")).first()
    assert tuple(row) == (997, 45, 74)


def test_top_rows_are_merged_by_a_task_not_the_driver(small):
    df = scoring.top_risk_transactions(small.repartition(16))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Coalesce 1" in plan and "TakeOrderedAndProject(limit=25" in plan
    scores = [(-r.risk_score, r.transaction_id) for r in df.collect()]
    assert scores == sorted(scores)
    everything = small.select("risk_score", "transaction_id").collect()
    assert scores == sorted((-r.risk_score, r.transaction_id) for r in everything)[:25]


def test_money_below_a_cent_adds_up(clean):
    amounts = [0.004] * 5 + [1.005, 2.675]
    df = clean(*[{"transaction_amount": a} for a in amounts])
    answer = QUESTIONS["executive_payment_kpis"].over_payments(df).first()
    assert answer.total_payment_volume == 3.70
    by_channel = QUESTIONS["fraud_by_channel"].over_payments(df).first()
    assert by_channel.avg_transaction_amount == 0.53


def test_rates_are_over_known_flags_and_reports_over_all_rows(clean):
    rows = [{"is_fraud": 1}, {"is_fraud": None}, {"is_fraud": 0}]
    df = clean(*rows)
    assert quality.overall_rates(df).first().fraud_rate_pct == 50.0
    assert quality.raw_outcome_rates(df).first().fraud_rate_pct == 50.0
    assert slices.slice_kpis(df).first().fraud_rate == 50.0
    assert QUESTIONS["executive_payment_kpis"].over_payments(df).first().fraud_rate_pct == 33.33


def test_shares_leave_out_missing_labels(clean):
    df = clean(*[{"is_fraud": x} for x in (0, 0, 1, None)])
    assert [tuple(r) for r in quality.label_shares(df).collect()] == [(0, 66.67), (1, 33.33)]


ORDERS = {
    "daily_payment_kpis": ["transaction_date"],
    "merchant_risk_summary": ["-fraud_rate_pct", "-chargeback_rate_pct", "merchant_id",
                              "merchant_category"],
    "failure_reason_summary": ["-transaction_count", "failure_reason"],
    "hourly_risk_summary": ["hour"],
    "daily_payment_trend": ["transaction_date"],
    "top_failure_reasons": ["-transaction_count", "failure_reason"],
    "fraud_by_channel": ["-fraud_rate_pct", "channel"],
    "chargeback_by_category": ["-chargeback_rate_pct", "merchant_category"],
    "weekend_vs_weekday_risk": ["-fraud_rate_pct", "day_type"],
    "slow_response_impact": ["-failure_rate_pct", "response_type"],
    "high_value_risk": ["-fraud_rate_pct", "transaction_value_type"],
    "payment_method_performance": ["-failure_rate_pct", "payment_method"],
    "monthly_risk_trend": ["month"],
    "location_based_risk": ["-fraud_rate_pct", "customer_location"],
    "high_risk_merchants": ["-fraud_rate_pct", "-chargeback_rate_pct", "merchant_id",
                            "merchant_category"],
    "high_risk_merchants_dashboard": ["-fraud_rate_pct", "-chargeback_rate_pct",
                                      "-failure_rate_pct", "merchant_id", "merchant_category"],
    "merchant_top5": ["-fraud_rate_pct", "-chargeback_rate_pct", "merchant_id",
                      "merchant_category"],
    "top_risk_transactions": ["-risk_score", "transaction_id"],
    "raw_status_counts": ["-transactions", "transaction_status"],
    "slice_fraud_by_channel": ["channel"],
    "slice_hourly_fraud": ["hour"],
    "slice_failure_counts": ["-count", "failure_reason"],
    "slice_risk_distribution": ["-transactions", "risk_level"],
    "distinct_values": ["column_name", "value"],
    "target_distribution": ["-share_pct", "is_fraud"],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_stated_orders(spark, name):
    rows = QUERIES[name](spark, "/root/testdata/sf0.01").collect()
    assert rows
    expected = list(rows)
    for key in reversed(ORDERS[name]):
        expected.sort(key=lambda r: r[key.lstrip("-")], reverse=key.startswith("-"))
    assert rows == expected


def test_rollup_of_many_merchants(spark, small):
    many = small.withColumn("merchant_id", F.concat(F.lit("M"), F.monotonically_increasing_id()))
    copies = many.crossJoin(spark.range(110)).withColumn(
        "merchant_id", F.concat("merchant_id", F.lit("-"), F.col("id"))
    ).drop("id")
    rollup = kpi_rollup(copies)
    counts = {r.grain: r["count"] for r in rollup.groupBy("grain").count().collect()}
    assert counts["merchant"] > 100_000
    assert counts["overall"] == 1
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    (expand,) = [line for line in plan.splitlines() if "Expand" in line][:1]
    assert "merchant_id" not in expand


def test_marts_are_sorted_once(spark, sf_dir):
    for name, mart in MARTS.items():
        for plan, sorts in ((mart, 1), (mart.unsorted(), 0)):
            df = plan.over_payments(txn(spark, sf_dir))
            text = df._jdf.queryExecution().executedPlan().toString()
            assert text.count("rangepartitioning") == sorts, name
