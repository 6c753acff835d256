"""Fit, compare, choose, store and apply the fraud classifiers."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial, reduce

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskledger.functions.risk_rules import PRE_TXN, level_of, score_of
from riskledger.models import boosting
from riskledger.models.features import (
    FEATURES,
    KEY,
    LABEL,
    NUMERIC_FEATURES,
    class_weight,
    complete,
    feature_frame,
    feature_manifest,
    preprocessing,
    stratified_split,
)
from riskledger.models.metrics import (
    METRICS,
    best_by_recall,
    binary_metrics,
    classification_report,
    confusion_matrix,
    roc_auc_scores,
)
from riskledger.session import materialise, remove_folder, shared_folder, spread
from riskledger.sinks import replace_table

SEED = 42
#: Rows of the training table that one task handles at least and at most.
ROWS_A_TASK = 5_000
MOST_ROWS_A_TASK = 250_000


@dataclass(frozen=True)
class ModelSizes:
    """Ensemble sizes; the defaults are fixed values, the published configuration."""

    trees: int = 200
    tree_depth: int = 12
    boost_rounds: int = 250
    boost_depth: int = 5
    logistic_iterations: int = 1000
    second_order_rounds: int = 250
    tree_memory_mb: int = 1024


#: Boosted trees by second derivatives, grown by ``boosting``; the last in the order of ties.
SECOND_ORDER = "Second-Order Boosted Trees"
NAMES = ["Logistic Regression", "Random Forest", "Gradient Boosted Trees", SECOND_ORDER]


@dataclass
class TrainingResult:
    """Small tables of figures, and the fitted models.

    ``confusion`` has the true and predicted class, ``report`` the classes and averages of
    each model; ``split_sizes`` the rows per class and side; ``metrics`` the unrounded figures
    that the best is chosen by.
    """

    comparison: DataFrame
    best_name: str
    best: PipelineModel
    models: dict[str, PipelineModel]
    confusion: DataFrame
    report: DataFrame
    split_sizes: DataFrame
    metrics: DataFrame


def candidates(n_train: int, sizes: ModelSizes) -> dict:
    """Classifiers in the order that decides ties.

    The logistic penalty is a fixed total, so per row it is one over the number of
    rows. There is no minimum split size in Spark's trees; a minimum leaf of half of it
    admits the same splits except very uneven ones.
    """
    return {
        "Logistic Regression": LogisticRegression(
            labelCol=LABEL,
            weightCol="weight",
            maxIter=sizes.logistic_iterations,
            regParam=1.0 / max(n_train, 1),
            elasticNetParam=0.0,
            standardization=False,
        ),
        "Random Forest": RandomForestClassifier(
            labelCol=LABEL,
            weightCol="weight",
            numTrees=sizes.trees,
            maxDepth=sizes.tree_depth,
            minInstancesPerNode=5,
            featureSubsetStrategy="sqrt",
            maxMemoryInMB=sizes.tree_memory_mb,
            seed=SEED,
        ),
        "Gradient Boosted Trees": GBTClassifier(
            labelCol=LABEL,
            maxIter=sizes.boost_rounds,
            maxDepth=sizes.boost_depth,
            stepSize=0.08,
            subsamplingRate=0.85,
            featureSubsetStrategy="0.85",
            maxMemoryInMB=sizes.tree_memory_mb,
            # Cuts the chain of per-round residuals through the shared folder.
            checkpointInterval=10,
            seed=SEED,
        ),
    }


def train(
    txn: DataFrame,
    sizes: ModelSizes | None = None,
    with_outcomes: bool = False,
    only: Sequence[str] | None = None,
    max_train_rows: int | None = None,
) -> TrainingResult:
    """Split, preprocess once, fit every candidate, compare on the test rows, choose.

    Candidates are fitted on every row marked train, however many there are, unless the caller
    sets ``max_train_rows``; no registered query does.
    """
    spark = txn.sparkSession
    # Also gives the boosted trees their checkpoint folder.
    path = shared_folder(spark, "training")
    try:
        # The many passes of training read this table, not the cleaning shuffle behind it.
        frame = complete(feature_frame(txn, with_outcomes))
        rows = materialise(stratified_split(frame), f"{path}/rows")
        return fit_and_compare(rows, sizes or ModelSizes(), path, only, max_train_rows)
    finally:
        remove_folder(spark, path)


def bounded_sample(rows: DataFrame, there: int, wanted: int) -> DataFrame:
    """About ``wanted`` of the rows, the same ones every time; all of them if there are fewer."""
    if there <= wanted:
        return rows
    part = F.pmod(F.xxhash64(KEY, F.lit("train")), F.lit(1_000_000))
    return rows.filter(part < wanted * 1_000_000 // there)


def fitted_rows(
    rows: DataFrame, sizes: DataFrame, max_train_rows: int | None = None
) -> DataFrame:
    """Of rows with their split, those that a training with these ``split_sizes`` is fitted on.

    All that are marked train, unless the training was given a bound.
    """
    train_rows = rows.filter(F.col("split") == "train")
    if max_train_rows is None:
        return train_rows
    there = sum(r["n"] for r in sizes.collect() if r["split"] == "train")
    return bounded_sample(train_rows, there, max_train_rows)


def fit_and_compare(
    rows: DataFrame,
    sizes: ModelSizes,
    folder: str,
    only: Sequence[str] | None = None,
    max_train_rows: int | None = None,
) -> TrainingResult:
    """Train on the rows marked train, judge on those marked test; ``folder`` is for scratch."""
    spark = rows.sparkSession
    # Two rows per class.
    sides = rows.groupBy(F.col(LABEL).alias("label"), "split").agg(F.count("*").alias("n"))
    sides = spark.createDataFrame(sides.collect(), "label INT, split STRING, n BIGINT")
    train_rows = fitted_rows(rows, sides, max_train_rows)
    test_rows = rows.filter(F.col("split") == "test")

    n, positives = train_rows.agg(
        F.count("*"), F.coalesce(F.sum(LABEL), F.lit(0))
    ).first()
    # Boosting makes over a thousand passes, each with a job for every level of a tree.
    train_rows = materialise(
        spread(train_rows, n, KEY, ROWS_A_TASK, MOST_ROWS_A_TASK), f"{folder}/train"
    )
    prepared = preprocessing().fit(train_rows)
    # Not persisted: every classifier keeps its own packed copy of its input while fitting.
    train_vectors = prepared.transform(train_rows).select(
        "features", LABEL, class_weight(F.col(LABEL), n, positives).alias("weight")
    )
    judged = prepared.transform(test_rows).select(KEY, LABEL, *FEATURES, "features")

    settings = boosting.BoostSettings(rounds=sizes.second_order_rounds, depth=sizes.boost_depth)
    fits = {
        name: partial(classifier.fit, train_vectors)
        for name, classifier in candidates(n, sizes).items()
    }
    fits[SECOND_ORDER] = partial(boosting.fit, train_rows, f"{folder}/second-order", settings)
    columns = {name: i for i, name in enumerate(NAMES) if not only or name in only}
    fitted = fit_side_by_side(spark, {name: fits[name] for name in columns})
    models: dict[str, PipelineModel] = {}
    for name, i in columns.items():
        before = [] if name == SECOND_ORDER else prepared.stages
        models[name] = PipelineModel(stages=[*before, fitted[name]])
        judged = with_judgement(fitted[name], judged, i)

    judged = materialise(judged.drop("features", *FEATURES), f"{folder}/judged")
    metrics = binary_metrics(
        judged, [(name, F.col(f"prediction_{i}")) for name, i in columns.items()]
    )
    scores = {name: f"probability_{i}" for name, i in columns.items()}
    auc = {r["scorer"]: r["roc_auc"] for r in roc_auc_scores(judged, scores, LABEL).collect()}
    # One row per candidate model, at most four and five per model.
    results = metrics.collect()
    confusion = collected_per_model(judged, columns, confusion_matrix)
    report = collected_per_model(judged, columns, classification_report)

    unrounded = spark.createDataFrame(results, metrics.schema).withColumn(
        "model_order", F.array_position(F.lit(NAMES), F.col("model"))
    )
    best_name = best_by_recall(unrounded).first()["model"]
    comparison = spark.createDataFrame(
        [
            (r["model"], *[round(r[m], 4) for m in METRICS], _rounded(auc.get(r["model"])))
            for r in results
        ],
        "model STRING, accuracy DOUBLE, precision DOUBLE, recall DOUBLE, "
        "f1_score DOUBLE, roc_auc DOUBLE",
    )
    return TrainingResult(
        comparison, best_name, models[best_name], models, confusion, report, sides, unrounded
    )


def fit_side_by_side(spark: SparkSession, fits: dict[str, Callable]) -> dict:
    """What each of ``fits`` returns. One's jobs run while another's driver plans the next."""
    with ThreadPoolExecutor(max(1, len(fits))) as pool:
        running = {name: pool.submit(inheritable_thread_target(spark)(fit)) for name, fit in fits.items()}
        return {name: one.result() for name, one in running.items()}


def of_model(result: TrainingResult, name: str) -> TrainingResult:
    """The part of a training that concerns one of its candidates."""
    comparison, confusion, report, metrics = (
        df.filter(F.col("model") == name)
        for df in (result.comparison, result.confusion, result.report, result.metrics)
    )
    own = result.models[name]
    return TrainingResult(
        comparison, name, own, {name: own}, confusion, report, result.split_sizes, metrics
    )


def together(results: Sequence[TrainingResult]) -> TrainingResult:
    """One comparison of candidates that were trained apart on the same rows, and its best."""
    comparison, confusion, report, metrics = (
        reduce(DataFrame.unionByName, [getattr(r, table) for r in results])
        for table in ("comparison", "confusion", "report", "metrics")
    )
    models = {name: model for r in results for name, model in r.models.items()}
    best_name = best_by_recall(metrics).first()["model"]
    return TrainingResult(
        comparison, best_name, models[best_name], models, confusion, report,
        results[0].split_sizes, metrics,
    )


def collected_per_model(judged: DataFrame, columns: dict[str, int], figures) -> DataFrame:
    """The few rows of ``figures`` for each model's predictions, as a local table."""
    parts = [
        figures(judged, LABEL, f"prediction_{i}").select(F.lit(name).alias("model"), "*")
        for name, i in columns.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return judged.sparkSession.createDataFrame(union.collect(), union.schema)


def store_training(result: TrainingResult, location: str) -> dict[str, DataFrame]:
    """Tables of a training, by name, and the chosen model under ``location``/best_model."""
    spark = result.comparison.sparkSession
    tables = {
        "model_comparison": result.comparison,
        "model_features": feature_manifest(spark),
        "model_confusion": result.confusion,
        "model_report": result.report,
    }
    save_model(result.best, f"{location}/best_model")
    return {
        name: replace_table(df, name, f"{location}/{name}") for name, df in tables.items()
    }


def _rounded(area: float | None) -> float | None:
    return None if area is None else round(area, 4)


def with_judgement(fitted, rows: DataFrame, number: int) -> DataFrame:
    """``rows`` with a model's prediction and probability in columns of its own."""
    return (
        fitted.transform(rows)
        .withColumn(f"prediction_{number}", F.col("prediction").cast("int"))
        .withColumn(f"probability_{number}", vector_to_array("probability")[1])
        .drop("rawPrediction", "probability", "prediction")
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def predict(model: PipelineModel, txn: DataFrame) -> DataFrame:
    """Fraud prediction and probability beside the in-flight rule level, batch or stream.

    Payments that lack a numeric feature keep their rule level and have no prediction.
    """
    ready = txn.withColumn("risk_score", score_of(PRE_TXN)).select(KEY, *FEATURES)
    usable = F.forall(
        F.array(*[F.col(c).isNotNull() for c in NUMERIC_FEATURES]), lambda known: known
    )
    return model.transform(ready).select(
        KEY,
        "risk_score",
        level_of("risk_score").alias("rule_risk_level"),
        F.when(usable, F.col("prediction").cast("int")).alias("fraud_prediction"),
        F.when(usable, vector_to_array("probability")[1]).alias("fraud_probability"),
    )
