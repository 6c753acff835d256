"""Classification metrics as aggregates over (label, prediction, score) columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

METRICS = ["accuracy", "precision", "recall", "f1_score"]


def ratio(part: Column, whole: Column) -> Column:
    """Zero instead of undefined, as classification reports show it."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction"):
    """Rows per pair of true and predicted class."""
    truth = F.col(label).cast("int").alias("label")
    return (
        df.groupBy(truth, F.col(prediction).cast("int").alias("prediction"))
        .agg(F.count("*").alias("transactions"))
        .orderBy("label", "prediction")
    )


def metrics_of(tp: str, fp: str, fn: str, tn: str) -> dict[str, Column]:
    hit, false_alarm, missed, passed = (F.col(c) for c in (tp, fp, fn, tn))
    return {
        "accuracy": ratio(hit + passed, hit + false_alarm + missed + passed),
        "precision": ratio(hit, hit + false_alarm),
        "recall": ratio(hit, hit + missed),
        "f1_score": ratio(2 * hit, 2 * hit + false_alarm + missed),
    }


def binary_metrics(
    df: DataFrame, predictions: Sequence[tuple[str, Column]], label: str = "is_fraud"
) -> DataFrame:
    """Metrics of several 0/1 predictions over the same rows, in one pass.

    ``predictions`` pairs a model name with its prediction column; ``model_order`` in the
    result is the position in that list.
    """
    truth = F.col(label) == 1
    counts = []
    for i, (_, prediction) in enumerate(predictions):
        says = prediction == 1
        counts += [
            F.count_if(truth & says).alias(f"tp{i}"),
            F.count_if(~truth & says).alias(f"fp{i}"),
            F.count_if(truth & ~says).alias(f"fn{i}"),
            F.count_if(~truth & ~says).alias(f"tn{i}"),
        ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("model_order"),
                F.lit(name).alias("model"),
                *[F.col(f"{c}{i}").alias(c) for c in ("tp", "fp", "fn", "tn")],
            )
            for i, (name, _) in enumerate(predictions)
        ]
    )
    per_model = df.agg(*counts).select(F.inline(rows))
    figures = metrics_of("tp", "fp", "fn", "tn")
    return per_model.select(
        "model_order", "model", *[figures[m].alias(m) for m in METRICS], "tp", "fp", "fn", "tn"
    )


def best_by_recall(metrics: DataFrame) -> DataFrame:
    """The model with the highest unrounded recall; the earlier one wins a tie."""
    return metrics.orderBy(F.desc("recall"), "model_order").limit(1)


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per-class rows, accuracy, and macro and support-weighted averages.

    Everything after the confusion counts works on at most four rows.
    """
    cells = confusion_matrix(df, label, prediction)
    per_class = (
        cells.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("class"),
                            F.when(F.col("label") == c, F.col("transactions"))
                            .otherwise(0)
                            .alias("support"),
                            F.when(F.col("prediction") == c, F.col("transactions"))
                            .otherwise(0)
                            .alias("predicted"),
                            F.when(
                                (F.col("label") == c) & (F.col("prediction") == c),
                                F.col("transactions"),
                            )
                            .otherwise(0)
                            .alias("hits"),
                        )
                        for c in (0, 1)
                    ]
                )
            )
        )
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
        .select(
            F.col("class").cast("string").alias("class"),
            ratio(F.col("hits"), F.col("predicted")).alias("precision"),
            ratio(F.col("hits"), F.col("support")).alias("recall"),
            ratio(2 * F.col("hits"), F.col("predicted") + F.col("support")).alias("f1_score"),
            "support",
            "hits",
        )
    )
    scores = ("precision", "recall", "f1_score")
    support = F.sum("support")
    averages = per_class.agg(
        support.alias("support"),
        ratio(F.sum("hits"), support).alias("accuracy"),
        *[F.avg(s).alias(f"macro_{s}") for s in scores],
        *[
            ratio(F.sum(F.col(s) * F.col("support")), support).alias(f"weighted_{s}")
            for s in scores
        ],
    )
    accuracy = F.struct(
        F.lit("accuracy").alias("class"),
        *[F.col("accuracy").alias(s) for s in scores],
        "support",
    )
    rows = [accuracy] + [
        F.struct(
            F.lit(f"{kind} avg").alias("class"),
            *[F.col(f"{kind}_{s}").alias(s) for s in scores],
            "support",
        )
        for kind in ("macro", "weighted")
    ]
    summary = averages.select(F.inline(F.array(*rows)))
    return per_class.drop("hits").unionByName(summary)


def roc_auc(df: DataFrame, scores: Mapping[str, str], label: str = "is_fraud") -> DataFrame:
    """Exact area under the ROC curve of scores with few distinct values, in one pass.

    ``scores`` maps a scorer's name to its column. Rows are first counted per scorer and
    score (rule scores take at most a few hundred integer values), so the ordered running
    sum sees that many rows and no more. Ties count half. ``roc_auc_scores`` is for
    continuous scores.
    """
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("scorer"), F.col(column).alias("score"))
            for name, column in scores.items()
        ]
    )
    by_score = (
        df.select(F.col(label).alias("label"), F.inline(pairs))
        .groupBy("scorer", "score")
        .agg(
            F.count_if(F.col("label") == 1).alias("positives"),
            F.count_if(F.col("label") == 0).alias("negatives"),
        )
    )
    upto = F.sum("negatives").over(W.partitionBy("scorer").orderBy("score"))
    half_tied = upto - F.col("negatives") / F.lit(2.0)
    all_pairs = F.sum("positives").cast("double") * F.sum("negatives")
    return (
        by_score.withColumn("wins", F.col("positives") * half_tied)
        .groupBy("scorer")
        .agg(F.try_divide(F.sum("wins"), all_pairs).alias("roc_auc"))
    )


def roc_auc_scores(
    df: DataFrame, scores: Mapping[str, str], label: str = "is_fraud", parts: int = 200
) -> DataFrame:
    """Exact areas under the ROC curves of any scores, of all scorers at once.

    Quantiles cut each scorer's scores into ranges; scores and labels are shuffled once, by
    range, and ranked inside their range. A range adds the pairs won inside it and, for each of
    its positives, all negatives of lower ranges: running sums over at most 2 x ``parts`` rows a
    scorer. A score that many rows share (it is several quantiles) is a range of its own, whose
    rows are only counted, so no task receives them. Ties count half; rows without a score are
    left out, a scorer without both classes has no area.
    """
    shares = [k / parts for k in range(1, parts)]
    # At most ``parts`` numbers per scorer.
    quantiles = df.agg(
        *[F.percentile_approx(F.col(c).cast("double"), shares, 100 * parts) for c in scores.values()]
    ).first()
    wide, structs = df, []
    for i, (name, column) in enumerate(scores.items()):
        own = quantiles[i] or [0.0]
        cuts, shared = sorted(set(own)), sorted({x for x in own if own.count(x) > 1})
        wide = wide.withColumn(f"__score_{i}", F.col(column).cast("double"))
        wide = Bucketizer(
            splits=[-float("inf"), *cuts, float("inf")],
            inputCol=f"__score_{i}",
            outputCol=f"__range_{i}",
            handleInvalid="keep",
        ).transform(wide)
        score = F.col(f"__score_{i}")
        is_shared = score.isin(shared) if shared else F.lit(False)
        structs.append(
            F.struct(
                F.lit(name).alias("scorer"),
                score.alias("score"),
                # Of equal quantile, the shared score comes before those above it.
                (F.col(f"__range_{i}").cast("int") * 2 + (~is_shared).cast("int")).alias("range"),
                is_shared.alias("shared"),
            )
        )
    rows = (
        wide.filter(F.col(label).isNotNull())
        .select((F.col(label) == 1).alias("positive"), F.inline(F.array(*structs)))
        .filter("score IS NOT NULL")
    )
    positives, negatives = F.count_if("positive"), F.count_if(~F.col("positive"))
    below = F.sum("negatives").over(W.partitionBy("scorer", "range").orderBy("score"))
    ranked = (
        rows.filter("NOT shared")
        .repartition("scorer", "range")
        .groupBy("scorer", "range", "score")
        .agg(positives.alias("positives"), negatives.alias("negatives"))
        .withColumn("wins", F.col("positives") * (below - F.col("negatives") / F.lit(2.0)))
        .groupBy("scorer", "range")
        .agg(*[F.sum(c).alias(c) for c in ("positives", "negatives", "wins")])
    )
    counted = (
        rows.filter("shared")
        .groupBy("scorer", "range")
        .agg(positives.alias("positives"), negatives.alias("negatives"))
        .withColumn("wins", F.col("positives") * F.col("negatives") / F.lit(2.0))
    )
    lower = F.sum("negatives").over(W.partitionBy("scorer").orderBy("range")) - F.col("negatives")
    all_pairs = F.sum("positives").cast("double") * F.sum("negatives")
    return (
        ranked.unionByName(counted)
        .withColumn("wins", F.col("wins") + F.col("positives").cast("double") * lower)
        .groupBy("scorer")
        .agg(F.try_divide(F.sum("wins"), all_pairs).alias("roc_auc"))
    )
