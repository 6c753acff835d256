import pytest
from pyspark.sql import functions as F

from riskledger.models import features as mf
from riskledger.models import metrics as mm
from riskledger.models import training as mt
from riskledger.registry import txn
from riskledger.session import shared_root

#: Ensembles that show the mechanics; the registered queries fit the full sizes.
SMALL = mt.ModelSizes(
    trees=10, tree_depth=5, boost_rounds=5, boost_depth=3, logistic_iterations=50,
    second_order_rounds=2,
)


@pytest.fixture(scope="module")
def payments_clean(spark):
    df = txn(spark, "/root/testdata/sf0.01").cache()
    df.count()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def logistic(payments_clean):
    return mt.train(payments_clean, SMALL, only=["Logistic Regression"])


def labelled(spark, *rows):
    return spark.createDataFrame(rows, "is_fraud INT, prediction INT")


def test_split_keeps_class_shares_and_is_repeatable(payments_clean):
    split = mf.stratified_split(payments_clean).groupBy("is_fraud", "split").count()
    sizes = {(r.is_fraud, r.split): r["count"] for r in split.collect()}
    n = sum(sizes.values())
    positives = sizes[1, "test"] + sizes[1, "train"]
    n_test = sizes[0, "test"] + sizes[1, "test"]
    assert n == payments_clean.count()
    assert n_test == -(-n // 5)
    assert abs(sizes[1, "test"] - 0.2 * positives) <= 1
    again = mf.stratified_split(payments_clean.repartition(3)).groupBy("is_fraud", "split").count()
    assert {(r.is_fraud, r.split): r["count"] for r in again.collect()} == sizes


def test_split_changes_with_the_seed(payments_clean):
    a = mf.stratified_split(payments_clean, seed=1).filter("split = 'test'")
    b = mf.stratified_split(payments_clean, seed=2).filter("split = 'test'")
    assert a.join(b, "transaction_id", "left_anti").count() > 0


def test_split_agrees_with_brute_force_at_any_bucket_width(payments_clean):
    import hashlib

    for digits in (1, 2):
        split = mf.stratified_split(payments_clean, bucket_digits=digits)
        got = {r.transaction_id: r.split for r in split.collect()}
        for label in (0, 1):
            ids = [r[0] for r in payments_clean.filter(F.col("is_fraud") == label)
                   .select("transaction_id").collect()]
            ids.sort(key=lambda i: (hashlib.md5(f"{i}42".encode()).hexdigest(), i))
            n_test = sum(got[i] == "test" for i in ids)
            assert all(got[i] == "test" for i in ids[:n_test])
            assert abs(n_test - 0.2 * len(ids)) <= 1


def largest_remainder(counts, n_test):
    """Training rows per class: whole parts, then one each by largest fraction."""
    n = sum(counts)
    train = [c * (n - n_test) // n for c in counts]
    rest = [c * (n - n_test) % n for c in counts]
    for i in sorted(range(len(counts)), key=lambda i: (-rest[i], i))[: n - n_test - sum(train)]:
        train[i] += 1
    return [c - t for c, t in zip(counts, train)]


def test_split_sizes_add_up_for_every_small_mix(spark):
    mixes = [(n, p) for n in range(2, 60) for p in range(1, n)]
    for n, positives in mixes[::37] + [(8, 2), (5, 1), (59, 30)]:
        counts = spark.createDataFrame([(0, n - positives), (1, positives)], "is_fraud INT, n BIGINT")
        got = dict(mf.split_sizes(counts, "is_fraud", 0.2).collect())
        n_test = -(-n // 5)
        assert sum(got.values()) == n_test
        assert [got[0], got[1]] == largest_remainder([n - positives, positives], n_test)


def test_one_null_neither_stops_training_nor_scoring(clean, payments_clean):
    holes = clean({"processor_response_ms": None}, {"transaction_datetime": None}, {}, {"is_fraud": 1})
    frame = mf.feature_frame(holes)
    assert mf.complete(frame).count() == 2
    assert mf.standardised_numerics(frame).count() == 2
    assert mf.feature_vectors(frame).count() == 2
    rows = payments_clean.unionByName(holes)
    result = mt.train(rows, SMALL, only=["Logistic Regression"])
    predicted = mt.predict(result.best, holes).orderBy("transaction_id").collect()
    assert [r.fraud_probability is None for r in predicted] == [True, True, False, False]


def test_scaling_a_single_row(clean):
    assert mf.standardised_numerics(mf.feature_frame(clean({}))).first().z_transaction_amount == 0.0


def test_training_is_bounded_but_judges_everything(payments_clean):
    result = mt.train(payments_clean, SMALL, only=["Logistic Regression"], max_train_rows=2000)
    sizes = {(r.label, r.split): r.n for r in result.split_sizes.collect()}
    judged = result.confusion.groupBy("label").agg(F.sum("transactions")).collect()
    assert dict(judged) == {label: n for (label, side), n in sizes.items() if side == "test"}
    report = {r["class"]: r.support for r in result.report.collect()}
    assert report["accuracy"] == sum(dict(judged).values())


def test_stored_training(spark, logistic, tmp_path):
    tables = mt.store_training(logistic, str(tmp_path))
    assert set(tables) == {"model_comparison", "model_features", "model_confusion", "model_report"}
    assert spark.table("model_comparison").count() == 1
    assert tables["model_features"].count() == 14
    assert mt.load_model(f"{tmp_path}/best_model").stages


def test_training_leaves_no_folder_behind(spark, payments_clean):
    root = spark._jvm.java.io.File(shared_root(spark))
    before = set(root.list() or [])
    mt.train(payments_clean, SMALL, only=["Gradient Boosted Trees"])
    left = set(root.list()) - before
    assert not [x for x in left if x.startswith("training")]


def test_split_of_a_tiny_class(clean):
    df = clean(*[{"is_fraud": int(i < 2)} for i in range(50)])
    split = mf.stratified_split(df)
    assert split.count() == 50
    assert split.filter("split = 'test'").count() == 10


def test_leak_free_score_is_the_default(clean):
    row = clean({"is_fraud": 1, "is_chargeback": 1, "channel": "Online"})
    assert mf.feature_frame(row).first().risk_score == 8
    assert mf.feature_frame(row, with_outcomes=True).first().risk_score == 83


def test_unseen_category_is_all_zeros(payments_clean):
    indexer, encoder = mf.category_encoding()
    rows = mf.feature_frame(payments_clean)
    index = indexer.fit(rows)
    encode = encoder.fit(index.transform(rows))
    new = rows.limit(1).withColumn("channel", F.lit("Carrier pigeon"))
    vector = encode.transform(index.transform(new)).first().channel_slots
    assert vector.size == 3
    assert vector.numNonzeros() == 0
    known = encode.transform(index.transform(rows)).first().channel_slots
    assert known.numNonzeros() == 1


def test_constant_feature_scales_to_zero(spark, clean):
    z = mf.standardised_numerics(mf.feature_frame(clean({}, {"transaction_amount": 30.0})))
    rows = z.orderBy("transaction_id").collect()
    assert [r.z_month for r in rows] == [0.0, 0.0]
    assert [r.z_transaction_amount for r in rows] == pytest.approx([-1.0, 1.0])


def test_metrics_without_any_positive_are_zero(spark):
    df = labelled(spark, (1, 0), (0, 0))
    row = mm.binary_metrics(df, [("never", F.col("prediction"))]).first()
    assert (row.accuracy, row.precision, row.recall, row.f1_score) == (0.5, 0.0, 0.0, 0.0)
    df = labelled(spark, (0, 1), (0, 0))
    row = mm.binary_metrics(df, [("none to find", F.col("prediction"))]).first()
    assert (row.precision, row.recall) == (0.0, 0.0)


def test_equal_recall_goes_to_the_earlier_model(spark):
    df = labelled(spark, (1, 1), (1, 0), (0, 0))
    same = F.col("prediction")
    worse = F.lit(0)
    metrics = mm.binary_metrics(df, [("worse", worse), ("first", same), ("second", same)])
    assert mm.best_by_recall(metrics).first().model == "first"


def test_auc_counts_ties_half(spark):
    rows = [(1, 5, 0), (0, 5, 0), (1, 9, 0), (0, 1, 0)]
    df = spark.createDataFrame(rows, "is_fraud INT, s INT, flat INT")
    areas = dict(mm.roc_auc(df, {"good": "s", "useless": "flat"}).collect())
    assert areas == {"good": pytest.approx(3.5 / 4), "useless": pytest.approx(0.5)}


def test_report_averages(spark):
    df = labelled(spark, (0, 0), (0, 0), (0, 1), (1, 1))
    report = {r["class"]: r for r in mm.classification_report(df, "is_fraud").collect()}
    assert report["0"].recall == pytest.approx(2 / 3)
    assert report["1"].precision == pytest.approx(0.5)
    assert report["accuracy"].f1_score == pytest.approx(0.75)
    assert report["macro avg"].recall == pytest.approx((2 / 3 + 1) / 2)
    assert report["weighted avg"].precision == pytest.approx((3 * 1 + 1 * 0.5) / 4)
    assert report["macro avg"].support == 4


def test_class_weights_balance(payments_clean):
    weights = mf.class_weights(payments_clean).collect()
    totals = [r.n * r.class_weight for r in weights]
    assert totals[0] == pytest.approx(totals[1])


def test_logistic_model_beats_chance_without_the_leak(logistic):
    row = logistic.comparison.first()
    assert row.model == "Logistic Regression"
    assert row.roc_auc > 0.8
    assert row.recall > 0.8


def test_leaky_features_give_full_recall(payments_clean):
    result = mt.train(
        payments_clean, SMALL, with_outcomes=True, only=["Logistic Regression"]
    )
    row = result.comparison.first()
    assert row.recall == 1.0
    assert row.roc_auc > 0.99


def test_stored_model_predicts_the_same(spark, payments_clean, logistic, tmp_path):
    path = str(tmp_path / "model")
    mt.save_model(logistic.best, path)
    sample = payments_clean.filter("is_fraud = 1")
    here = mt.predict(logistic.best, sample).orderBy("transaction_id").collect()
    there = mt.predict(mt.load_model(path), sample).orderBy("transaction_id").collect()
    assert here == there
    assert all(0 <= r.fraud_probability <= 1 for r in here)


def test_all_candidates_in_order(payments_clean):
    result = mt.train(payments_clean, SMALL)
    assert [r.model for r in result.comparison.collect()] == [
        "Logistic Regression",
        "Random Forest",
        "Gradient Boosted Trees",
        "Second-Order Boosted Trees",
    ]
    best = max(result.comparison.collect(), key=lambda r: r.recall)
    assert result.best_name == best.model


def test_manifest(spark):
    manifest = dict(mf.feature_manifest(spark).collect())
    assert len(manifest) == 14
    assert manifest["risk_score"] == "numeric"
    assert manifest["channel"] == "categorical"
