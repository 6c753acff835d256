import pytest

from riskledger.functions.risk_rules import POST_TXN, level_of
from riskledger.operators import scoring

EVERYTHING = {
    "transaction_amount": 2000.0,
    "is_fraud": 1,
    "is_chargeback": 1,
    "transaction_status": "Failed",
    "processor_response_ms": 900,
    "channel": "Online",
    "merchant_category": "Travel",
    "customer_location": "FL",
}


def scored(clean, *rows):
    df = scoring.score_transactions(clean(*rows)).orderBy("transaction_id")
    return [(r.risk_score, r.risk_reason) for r in df.collect()]


@pytest.mark.parametrize(
    ("row", "points", "label"),
    [
        ({"transaction_amount": 499.99}, 0, "No major indicators"),
        ({"transaction_amount": 500.0}, 10, "Elevated amount"),
        ({"transaction_amount": 999.99}, 10, "Elevated amount"),
        ({"transaction_amount": 1000.0}, 20, "High amount"),
        ({"transaction_amount": 1999.99}, 20, "High amount"),
        ({"transaction_amount": 2000.0}, 30, "Very high amount"),
        ({"is_fraud": 1}, 40, "Fraud indicator"),
        ({"is_chargeback": 1}, 35, "Chargeback"),
        ({"transaction_status": "Failed"}, 15, "Failed transaction"),
        ({"processor_response_ms": 900}, 10, "Slow processor response"),
        ({"channel": "Online"}, 8, "Online channel"),
        ({"channel": "Mobile App"}, 4, "Mobile channel"),
        ({"merchant_category": "Electronics"}, 12, "High-risk merchant category"),
        ({"merchant_category": "Financial Services"}, 12, "High-risk merchant category"),
        ({"customer_location": "NV"}, 8, "High-risk location"),
        ({"customer_location": "NY"}, 8, "High-risk location"),
        ({"customer_location": None, "channel": None}, 0, "No major indicators"),
    ],
)
def test_each_rule_alone(clean, row, points, label):
    assert scored(clean, row) == [(points, label)]


def test_every_rule_at_once(clean):
    [(score, reason)] = scored(clean, EVERYTHING)
    assert score == 158
    assert reason == (
        "Very high amount, Fraud indicator, Chargeback, Failed transaction, "
        "Slow processor response, Online channel, High-risk merchant category, "
        "High-risk location"
    )


def test_reason_list_holds_the_same_labels(clean):
    row = scoring.score_transactions(clean(EVERYTHING, {}), keep_reason_list=True)
    for r in row.collect():
        assert (", ".join(r.risk_reasons) or "No major indicators") == r.risk_reason


def test_score_in_flight_ignores_outcomes(clean):
    row = scoring.score_in_flight(clean(EVERYTHING)).first()
    assert row.pre_txn_risk_score == 158 - 40 - 35
    assert row.pre_txn_risk_level == "Critical Risk"


def test_levels_include_their_floor(spark):
    df = spark.createDataFrame([(s,) for s in (0, 24, 25, 49, 50, 74, 75, 158)], "s INT")
    names = [r[0] for r in df.select(level_of("s")).collect()]
    assert names == (
        ["Low Risk"] * 2 + ["Medium Risk"] * 2 + ["High Risk"] * 2 + ["Critical Risk"] * 2
    )


def test_highest_possible_score():
    assert sum(max(step.points for step in group.steps) for group in POST_TXN) == 158


def test_level_summary_shares_and_order(clean):
    rows = [{}] * 3 + [EVERYTHING]
    summary = scoring.risk_level_summary(scoring.score_transactions(clean(*rows))).collect()
    assert [tuple(r) for r in summary] == [
        ("Critical Risk", 1, 158.0, 25.0),
        ("Low Risk", 3, 0.0, 75.0),
    ]


def test_ties_in_the_ranking_go_to_the_smaller_id(clean):
    df = scoring.score_transactions(clean(*[{"channel": "Online"}] * 30, EVERYTHING))
    top = scoring.top_risk_transactions(df.repartition(5)).collect()
    assert len(top) == 25
    assert top[0].transaction_id == "TXN00000030"
    assert [r.transaction_id for r in top[1:]] == [f"TXN{i:08d}" for i in range(24)]


def test_scoring_adds_no_shuffle_and_no_python(clean):
    plan = scoring.score_transactions(clean(EVERYTHING))._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "Exchange" not in text
    assert "Python" not in text
