"""Boosting against plain numpy, certificates of fits, models as tables, exact areas."""

import math
import re

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskledger import registry
from riskledger.models import boosting, certificates, tables
from riskledger.models import features as mf
from riskledger.models import metrics as mm
from riskledger.models import training as mt
from riskledger.registry import stamp, txn
from riskledger.session import materialise, spread, temporary_folder

SMALL = mt.ModelSizes(
    trees=6, tree_depth=4, boost_rounds=4, boost_depth=3, logistic_iterations=200, second_order_rounds=3
)


@pytest.fixture(scope="module")
def frame(spark):
    rows = mf.complete(mf.feature_frame(txn(spark, "/root/testdata/sf0.01")))
    return materialise(rows, temporary_folder(spark, "frame"))


@pytest.fixture(scope="module")
def payments(spark):
    return materialise(txn(spark, "/root/testdata/sf0.01"), temporary_folder(spark, "payments"))


@pytest.fixture(scope="module")
def trained(payments):
    return mt.train(payments, SMALL)


@pytest.fixture(scope="module")
def train_rows(spark, frame):
    rows = mf.stratified_split(frame).filter("split = 'train'").drop("split")
    return materialise(rows, temporary_folder(spark, "train"))


# -- boosting -------------------------------------------------------------------------------


def brute_boost(bins, labels, masks, columns, settings):
    """Sums of trees grown by looking at every split of every node, row by row."""
    n = len(labels)
    total = np.full(n, math.log(labels.mean() / (1 - labels.mean())))
    for round_ in range(settings.rounds):
        p = 1 / (1 + np.exp(-total))
        unit = boosting.UNIT
        g = np.round((p - labels) / unit) * unit
        h = np.round(np.maximum(p * (1 - p), 1e-16) / unit) * unit
        take = masks[round_]
        value = np.zeros(n)

        def split(rows, depth):
            own = rows & take
            gs, hs = g[own].sum(), h[own].sum()
            best = (settings.least_gain, None)
            if depth < settings.depth:
                for c in boosting.drawn_columns(len(columns), round_, settings):
                    f, v = columns[c]
                    cuts = [v] if v is not None else sorted(set(bins[own, f].tolist()))[1:]
                    for cut in cuts:
                        right = bins[:, f] == v if v is not None else bins[:, f] >= cut
                        gr, hr = g[own & right].sum(), h[own & right].sum()
                        if min(hr, hs - hr) < settings.least_hessian:
                            continue
                        gain = (gr**2 / (hr + 1) + (gs - gr) ** 2 / (hs - hr + 1) - gs**2 / (hs + 1)) / 2
                        if gain > best[0] + 1e-12:
                            best = (gain, right)
            if best[1] is None:
                value[rows] = -settings.step * gs / (hs + settings.l2)
                return
            split(rows & ~best[1], depth + 1)
            split(rows & best[1], depth + 1)

        split(np.ones(n, bool), 0)
        total = total + value
    return total


@pytest.mark.parametrize("at_a_time", [25, 2])
def test_boosting_equals_brute_force(spark, frame, monkeypatch, at_a_time):
    monkeypatch.setattr(boosting, "TREES_AT_A_TIME", at_a_time)
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 100)
    settings = boosting.BoostSettings(rounds=5, depth=3, step=0.3, bins=16)
    few = frame.orderBy(F.md5("transaction_id")).limit(350).unionByName(frame.filter("is_fraud = 1").limit(150))
    few = materialise(few.distinct(), temporary_folder(spark, "few"))
    model = boosting.fit(few, temporary_folder(spark, "boost"), settings)
    base, bins, trees = model.parts()
    assert len(trees) == 5 and all(1 <= len(c) <= 15 for c in list(bins.cuts.values())[:2])
    part = [F.pmod(F.xxhash64("transaction_id", F.lit(k), F.lit(42)), F.lit(1_000_000)) < 850_000 for k in range(5)]
    total = boosting.margin(boosting.literal(trees), F.col("bins"), 3, F.lit(base))
    rows = few.select("transaction_id", "is_fraud", bins.expression().alias("bins"), F.array(*part).alias("masks"))
    got = rows.withColumn("total", total).collect()
    expected = brute_boost(
        np.array([r.bins for r in got]), np.array([r.is_fraud for r in got], float),
        np.array([r.masks for r in got]).T, bins.columns(), settings,
    )
    assert [r.total for r in got] == pytest.approx(expected.tolist(), abs=1e-9)
    assert len({round(r.total, 6) for r in got}) > 10
    # Numpy and column expressions walk trees alike.
    matrix = np.array([r.bins for r in got])
    assert (base + sum(t.values_of(matrix) for t in trees)).tolist() == pytest.approx(expected.tolist())


def test_bins(spark):
    rows = [(f"t{i}", i % 2, float(i % 40), None if i % 7 == 0 else f"v{i % 3}") for i in range(400)]
    df = spark.createDataFrame(rows, "transaction_id STRING, is_fraud INT, x DOUBLE, c STRING")
    bins = boosting.find_bins(df, ["x"], ["c"], 256)
    assert bins.cuts["x"] == [float(k) for k in range(1, 40)] and bins.values["c"] == ["v0", "v1", "v2"]
    new = spark.createDataFrame([(-5.0, "v1"), (7.0, "new"), (7.5, None), (99.0, "v2")], "x DOUBLE, c STRING")
    assert [r[0] for r in new.select(bins.expression()).collect()] == [[0, 1], [7, -1], [7, -1], [39, 2]]
    assert len(boosting.find_bins(df, ["x"], ["c"], 8).cuts["x"]) <= 7


def test_boosting_one_class_and_no_rows(spark, frame):
    settings = boosting.BoostSettings(rounds=2, depth=2)
    never = materialise(frame.filter("is_fraud = 0").limit(30), temporary_folder(spark, "never"))
    model = boosting.fit(never, temporary_folder(spark, "b1"), settings)
    assert model.transform(never).filter("prediction <> 0").isEmpty()
    none = materialise(frame.limit(0), temporary_folder(spark, "none"))
    assert boosting.fit(none, temporary_folder(spark, "b2"), settings).transform(never).count() == 30


def test_histogram_of_many_batches(spark):
    """The sums of the rows' own derivatives, as whole numbers."""
    n = 25_000
    df = spark.range(n, numPartitions=1).select(
        F.col("id").cast("string").alias("key"),
        (F.col("id") % 3 == 0).cast("double").alias("label"),
        # Features whose highest bin comes late, and an unknown value.
        F.array((F.col("id") / 1000).cast("int"), (F.col("id") % 5 - 1).cast("int")).alias("bins"),
        F.lit(0.25).alias("total"),
    )
    settings = boosting.BoostSettings(row_share=1.0)
    partial = boosting.histogram(df, [boosting.Tree(2)], 0, 0, settings)
    got = {(r.node, r.feature, r.bin): (r.g, r.h) for r in partial.collect()}
    p = 1 / (1 + math.exp(-0.25))
    expected = {}
    for i in range(n):
        g, h = (int(np.round(x / boosting.UNIT)) for x in (p - (i % 3 == 0), p * (1 - p)))
        for feature, own in enumerate((i // 1000, i % 5 - 1)):
            a, b = expected.get((0, feature, own), (0, 0))
            expected[0, feature, own] = a + g, b + h
    assert got == expected


def test_whole_sums_are_exact():
    units = np.array([(1 << 40) - 1, -(1 << 40) + 3, 1, -1] * 60_000 + [1 << 40] * 30_000)
    code = np.arange(len(units)) % 2
    expected = [sum(units[code == c].tolist()) for c in (0, 1)]
    assert boosting._whole_sums(code, units, 3).tolist() == [*expected, 0]


# -- certificates ---------------------------------------------------------------------------


@pytest.mark.parametrize("name", ["Random Forest", "Gradient Boosted Trees"])
def test_leaf_sums_equal_the_leaves_of_every_row(trained, train_rows, name):
    table = tables.model_table(train_rows.sparkSession, trained.models[name])
    weighted = train_rows.withColumn("weight", 1.0 + F.col("is_fraud"))
    sums = certificates.leaf_sums(table, weighted, "is_fraud", "weight")
    # A row per task and leaf at most, whatever the number of rows.
    assert sums.groupBy("tree", "node").count().agg(F.max("count")).first()[0] <= weighted.rdd.getNumPartitions()
    got = sums.groupBy("tree", "node").agg(F.sum("n"), F.sum("weight"), F.sum("total")).collect()
    leaves = weighted.select("is_fraud", "weight", F.posexplode(tables.scoring(table).leaves).alias("tree", "node"))
    value = F.col("is_fraud") * F.col("weight")
    expected = leaves.groupBy("tree", "node").agg(F.count("*"), F.sum("weight"), F.sum(value)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, expected))


def test_a_bounded_fit_is_certified_over_its_own_rows(payments, frame):
    split = mf.stratified_split(frame)
    result = mt.train(payments, SMALL, only=["Logistic Regression"], max_train_rows=2000)
    own = mt.fitted_rows(split, result.split_sizes, 2000)
    assert 1500 < own.count() < 2500
    assert certificates.certificates(result.models, own).first().holds
    everything = mt.fitted_rows(split, result.split_sizes)
    assert not certificates.certificates(result.models, everything).first().holds


def test_certificates_hold(trained, train_rows):
    settings = boosting.BoostSettings(rounds=3, depth=3)
    rows = certificates.certificates(trained.models, train_rows, settings).collect()
    assert [r.model for r in rows] == mt.NAMES
    assert all(r.holds for r in rows), rows


def test_a_constant_classifier_is_red(trained, train_rows):
    fitted = trained.models["Logistic Regression"]
    n, positives = train_rows.count(), train_rows.filter("is_fraud = 1").count()
    vectors = train_rows.withColumn("weight", mf.class_weight(F.col("is_fraud"), n, positives))
    for stage in fitted.stages[:-1]:
        vectors = stage.transform(vectors)
    constant = LogisticRegression(labelCol="is_fraud", weightCol="weight", maxIter=0).fit(vectors)
    models = {"constant": PipelineModel(stages=[*fitted.stages[:-1], constant])}
    assert not certificates.certificates(models, train_rows).first().holds


def test_wrong_leaves_are_red(trained, train_rows):
    settings = boosting.BoostSettings(rounds=3, depth=3)
    base, bins, trees = trained.models[mt.SECOND_ORDER].stages[-1].parts()
    trees[-1].value = [0.0] * len(trees[-1].value)
    wrong = boosting.BoostedModel.of(base, bins, trees, settings)
    assert certificates.boosted_leaf_error(wrong, train_rows, settings=settings) > certificates.LEAF_TOLERANCE
    forest = trained.models["Random Forest"]
    flipped = train_rows.withColumn("other", 1 - F.col("is_fraud")).withColumn("weight", F.lit(1.0))
    assert certificates.leaf_distance(forest, flipped, "other", "weight") > certificates.NOISE_TOLERANCE


# -- models as tables -----------------------------------------------------------------------


@pytest.mark.parametrize("name", mt.NAMES[:3])
def test_table_scores_like_the_model(spark, trained, frame, name):
    model = trained.models[name]
    path = temporary_folder(spark, "parameters")
    tables.model_table(spark, model).write.parquet(path)
    table = spark.read.parquet(path)
    odd = frame.limit(3).withColumns({"transaction_id": F.lit("odd"), "channel": F.lit("Carrier pigeon")})
    rows = frame.unionByName(odd.limit(1))
    theirs = model.transform(rows).select("transaction_id", "prediction", vector_to_array("probability")[1].alias("p"))
    both = theirs.join(tables.score(table, rows, "transaction_id"), "transaction_id")
    gap, differ = both.agg(
        F.max(F.abs(F.col("p") - F.col("fraud_probability"))),
        F.count_if(F.col("prediction") != F.col("fraud_prediction")),
    ).first()
    assert gap < 1e-9 and differ == 0 and both.count() == rows.count()
    missing = tables.score(table, frame.limit(1).withColumn("hour", F.lit(None).cast("int")))
    assert missing.first().fraud_probability is None


def test_table_scores_a_stream(spark, trained, frame):
    table = tables.model_table(spark, trained.models["Gradient Boosted Trees"])
    source, out = temporary_folder(spark, "source"), temporary_folder(spark, "out")
    frame.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(source)
    query = tables.score(table, stream, "transaction_id").writeStream.format("parquet")
    checkpoint = temporary_folder(spark, "checkpoint")
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out).awaitTermination()
    streamed = spark.read.parquet(out)
    assert streamed.exceptAll(tables.score(table, frame, "transaction_id")).isEmpty()
    assert streamed.count() == frame.count()


# -- scaling and areas ----------------------------------------------------------------------


def test_the_model_scales_by_the_population(spark, trained, frame, train_rows, tmp_path):
    scaler = trained.models["Logistic Regression"].stages[0]
    expected = train_rows.agg(*[F.stddev_pop(c) for c in mf.NUMERIC_FEATURES]).first()
    assert scaler.getOrDefault("deviations") == pytest.approx(list(expected))
    PipelineModel(stages=[scaler]).write().overwrite().save(str(tmp_path / "scaler"))
    again = PipelineModel.load(str(tmp_path / "scaler"))
    assert again.transform(frame).select("scaled").exceptAll(scaler.transform(frame).select("scaled")).isEmpty()


@pytest.mark.parametrize("name", [mt.NAMES[0], mt.SECOND_ORDER])
def test_loaded_model_predicts_the_same(payments, trained, tmp_path, name):
    mt.save_model(trained.models[name], str(tmp_path / "m"))
    here = mt.predict(trained.models[name], payments)
    assert mt.predict(mt.load_model(str(tmp_path / "m")), payments).exceptAll(here).isEmpty()


def scores(spark):
    df = spark.range(4000).select(
        (F.pmod(F.xxhash64("id"), F.lit(10)) < 3).cast("int").alias("is_fraud"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 1000).alias("u"),
    )
    return df.withColumns(
        {
            "fine": F.col("is_fraud") * 0.3 + F.col("u"),
            "tied": F.when(F.col("u") < 0.4, 0.5).otherwise(F.round("u", 2)),
            "flat": F.lit(1.0),
            "holes": F.when(F.col("u") > 0.2, F.col("u") - F.col("is_fraud") * 0.1),
        }
    )


def test_areas_equal_the_evaluator(spark):
    df = materialise(scores(spark), temporary_folder(spark, "scores"))
    areas = dict(mm.roc_auc_scores(df, {c: c for c in ("fine", "tied", "flat", "holes")}).collect())
    for name, area in areas.items():
        own = df.filter(F.col(name).isNotNull()).withColumn("l", F.col("is_fraud").cast("double"))
        evaluator = BinaryClassificationEvaluator(rawPredictionCol=name, labelCol="l", numBins=0)
        assert area == pytest.approx(evaluator.evaluate(own), abs=1e-12)


def test_areas_take_one_shuffle_of_rows(spark):
    df = materialise(scores(spark), temporary_folder(spark, "scores"))
    plan = mm.roc_auc_scores(df, {"a": "fine", "b": "tied"})._jdf.queryExecution().executedPlan().toString()
    by_range = re.findall(r"Exchange hashpartitioning\(scorer#\d+, range#\d+, \d+\), (\w+)", plan)
    assert sorted(by_range) == ["ENSURE_REQUIREMENTS", "REPARTITION_BY_COL"]  # counts, rows
    assert not re.search(r"hashpartitioning\(scorer#\d+, range#\d+, score", plan)


def test_areas_without_rows_or_a_class(spark):
    df = scores(spark).filter("is_fraud = 0")
    assert mm.roc_auc_scores(df, {"a": "fine"}).first().roc_auc is None
    assert mm.roc_auc_scores(df.limit(0), {"a": "fine"}).count() == 0


def test_a_changed_table_is_trained_anew(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    df.limit(50).write.parquet(f"{tmp_path}/events.parquet")
    before = stamp(spark, str(tmp_path), "events")
    df.limit(60).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert stamp(spark, str(tmp_path), "events") != before


# -- fitting --------------------------------------------------------------------------------


def test_fitting_takes_a_task_a_slot(spark, payments, monkeypatch):
    """Tasks go by the slots there are and not by the rows, however many passes are made."""
    seen = []

    class Spy(LogisticRegression):
        def _fit(self, dataset):
            seen.append(dataset.rdd.glom().map(len).collect())
            return super()._fit(dataset)

    spy = Spy(labelCol="is_fraud", weightCol="weight", maxIter=2)
    monkeypatch.setattr(mt, "candidates", lambda n, sizes: {"Logistic Regression": spy})
    monkeypatch.setattr(mt, "ROWS_A_TASK", 100)
    in_many_files = payments.repartition(40)
    result = mt.train(in_many_files, SMALL, only=["Logistic Regression"])
    n = sum(r.n for r in result.split_sizes.collect() if r.split == "train")
    slots = spark.sparkContext.defaultParallelism
    assert sum(seen[0]) == n and len(seen[0]) == slots and max(seen[0]) < 1.3 * n / slots


def test_rows_are_spread_by_key(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("key"))
    slots = spark.sparkContext.defaultParallelism
    for least, most, tasks in ((2000, 9000, 1), (10, 9000, slots), (10, 50, max(slots, 21))):
        parts = spread(df, 1000, "key", least, most).rdd.glom().collect()
        assert len(parts) == tasks and all(part == sorted(part) for part in parts)


def test_a_query_of_one_candidate_fits_that_alone(spark, payments, monkeypatch, tmp_path):
    asked = []

    def train(rows, with_outcomes=False, only=None, original=mt.train):
        asked.append(list(only))
        return original(payments, SMALL, with_outcomes, only)

    monkeypatch.setattr(mt, "train", train)
    monkeypatch.setattr(registry, "_trained", {})
    data = "/root/testdata/sf0.001"
    forest = registry.QUERIES["random_forest"](spark, data).collect()
    assert asked == [["Random Forest"]] and {r.model for r in forest} == {"Random Forest"}
    whole = registry.trained(spark, data)
    assert asked[1:] == [["Logistic Regression", "Gradient Boosted Trees"]]
    assert [r.model for r in whole.comparison.collect()] == mt.NAMES[:3] == list(whole.models)
    recall = {r.model: r.recall for r in whole.metrics.collect()}
    assert whole.best_name == max(mt.NAMES[:3], key=recall.get) and whole.best is whole.models[whole.best_name]
    assert sorted(registry.QUERIES["random_forest"](spark, data).collect()) == sorted(forest)
    assert registry.QUERIES["model_comparison"](spark, data).count() == 6
    assert len(asked) == 2


# -- all rows -------------------------------------------------------------------------------


def test_all_rows_marked_train_are_fitted_on(spark):
    """However many there are: these sizes claim fifty million."""
    rows = spark.range(1000).select(F.col("id").cast("string").alias("transaction_id"), F.lit("train").alias("split"))
    sizes = spark.createDataFrame([(0, "train", 49_000_000), (1, "train", 1_000_000)], "label INT, split STRING, n BIGINT")
    assert mt.fitted_rows(rows, sizes).count() == 1000


@pytest.mark.parametrize("name", [mt.NAMES[0], mt.SECOND_ORDER])
def test_a_training_of_more_than_a_million_rows_takes_them_all(spark, monkeypatch, name):
    n = 1_200_000
    spread_out = {c: (F.col("id") % (7 + i)).cast("int") for i, c in enumerate(mf.NUMERIC_FEATURES)}
    values = {c: F.concat(F.lit("v"), F.col("id") % 3) for c in mf.CATEGORICAL_FEATURES}
    rows = spark.range(n + 1000).select(
        F.format_string("T%08d", "id").alias("transaction_id"),
        *[x.alias(c) for c, x in {**spread_out, **values}.items()],
        (F.pmod(F.xxhash64("id"), F.lit(10)) < 2).cast("int").alias("is_fraud"),
        F.when(F.col("id") < n, "train").otherwise("test").alias("split"),
    )
    seen = []
    original = mt.boosting.fit

    class Spy(LogisticRegression):
        def _fit(self, dataset):
            seen.append(dataset.count())
            return super()._fit(dataset)

    def spy(train_rows, folder, settings):
        seen.append(train_rows.count())
        return original(train_rows.limit(1000), folder, settings)

    classifier = Spy(labelCol="is_fraud", weightCol="weight", maxIter=1)
    monkeypatch.setattr(mt, "candidates", lambda n, sizes: {mt.NAMES[0]: classifier})
    monkeypatch.setattr(mt.boosting, "fit", spy)
    folder = temporary_folder(spark, "million")
    stored = materialise(rows, f"{folder}/rows")
    mt.fit_and_compare(stored, mt.ModelSizes(second_order_rounds=1), folder, [name])
    assert seen == [n]


def test_sums_of_derivatives_fit_a_long_however_many_rows():
    assert boosting.unit_for(0) == boosting.unit_for(4_000_000) == boosting.UNIT
    for n in (2**22, 2**23, 10**9, 10**13):
        unit = boosting.unit_for(n)
        assert n / unit < 2**63 and unit == 2.0 ** round(math.log2(unit))


def test_a_fit_takes_its_unit_from_its_rows(spark, frame, monkeypatch):
    """Leaves are right, and sums whole, in units as large as trillions of rows would need."""
    rows = materialise(frame.limit(400), temporary_folder(spark, "coarse"))
    settings = boosting.BoostSettings(rounds=2, depth=2)
    fine = boosting.fit(rows, temporary_folder(spark, "u1"), settings).parts()[2]
    monkeypatch.setattr(boosting, "unit_for", lambda n: 2.0**-22)
    model = boosting.fit(rows, temporary_folder(spark, "u2"), settings)
    coarse = model.parts()[2]
    assert [t.feature for t in fine] == [t.feature for t in coarse] and fine != coarse
    assert [v for t in fine for v in t.value] == pytest.approx([v for t in coarse for v in t.value], abs=1e-4)
    assert certificates.boosted_leaf_error(model, rows, settings=settings) < 1e-4


def test_a_level_of_nine_million_rows_adds_up(spark):
    n = 9_000_000
    df = spark.range(n, numPartitions=8).select(
        F.col("id").cast("string").alias("key"), F.lit(0.0).alias("label"), F.array(F.lit(3)).alias("bins"),
        F.lit(40.0).alias("total"),
    )
    settings = boosting.BoostSettings(row_share=1.0, unit=boosting.unit_for(n))
    row = boosting.histogram(df, [boosting.Tree(1)], 0, 0, settings).first()
    assert (row.node, row.feature, row.bin) == (0, 0, 3) and row.g * settings.unit == pytest.approx(n, rel=1e-9)
