"""Model features, preprocessing stages and the train/test split."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSizeHint
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskledger.functions.risk_rules import POST_TXN, PRE_TXN, score_of
from riskledger.models.scaling import PopulationScaler

# Label, key and features, in order.
LABEL = "is_fraud"
KEY = "transaction_id"
NUMERIC_FEATURES = [
    "transaction_amount",
    "processor_response_ms",
    "hour",
    "month",
    "is_weekend",
    "high_value_txn",
    "slow_response",
    "risk_score",
]
CATEGORICAL_FEATURES = [
    "payment_method",
    "channel",
    "device_type",
    "merchant_category",
    "customer_location",
    "transaction_status",
]
FEATURES = NUMERIC_FEATURES + CATEGORICAL_FEATURES


def feature_frame(txn: DataFrame, with_outcomes: bool = False) -> DataFrame:
    """Id, features and label.

    The rule score is one of the features. By default it leaves out the fraud and
    chargeback rules, because those give the label away. ``with_outcomes`` keeps them,
    which reproduces the published near-perfect figures and is useless for prediction.
    """
    rules = POST_TXN if with_outcomes else PRE_TXN
    return txn.withColumn("risk_score", score_of(rules)).select(KEY, *FEATURES, LABEL)


def complete(features: DataFrame) -> DataFrame:
    """Rows that have all numeric features; models can't use the others.

    ``incomplete_rows`` of the cleaning counters tells how many those are.
    """
    return features.na.drop(subset=NUMERIC_FEATURES)


def feature_manifest(spark: SparkSession) -> DataFrame:
    rows = [(f, "numeric") for f in NUMERIC_FEATURES]
    rows += [(f, "categorical") for f in CATEGORICAL_FEATURES]
    return spark.createDataFrame(rows, "feature STRING, type STRING")


def where_running_total_reaches(
    counts: DataFrame, label: str, order: list[str], wanted: str
) -> DataFrame:
    """Per label, the row at which the running sum of ``n`` reaches ``wanted``.

    ``still_needed`` is how many of that row's ``n`` it takes. The running sum sees
    counts per bucket or the keys of one bucket, never the rows themselves.
    """
    running = F.sum("n").over(W.partitionBy(label).orderBy(*order))
    reached = (F.col("upto") >= F.col(wanted)) & (F.col("upto") - F.col("n") < F.col(wanted))
    return (
        counts.withColumn("upto", running)
        .filter(reached)
        .select(label, *order, (F.col(wanted) - F.col("upto") + F.col("n")).alias("still_needed"))
    )


def match(rows: DataFrame, cuts: DataFrame, *columns: str) -> DataFrame:
    """Rows of the cut's bucket, with ``still_needed``; ``cuts`` has one row per class.

    Null-safe equality, because plain equality would add not-null filters to this use of
    the input alone and so keep Spark from sharing one scan or shuffle between all uses.
    """
    cuts = cuts.select(*[F.col(c).alias(f"cut_{c}") for c in columns], "still_needed")
    same = [F.col(c).eqNullSafe(F.col(f"cut_{c}")) for c in columns]
    return rows.join(F.broadcast(cuts), same).drop(*[f"cut_{c}" for c in columns])


def split_sizes(by_class: DataFrame, label: str, test_fraction: float) -> DataFrame:
    """(label, test_n) from (label, n): test rows per class, ``ceil(test_fraction * all)`` in all.

    Every class first gives the whole part of its share to training; the training rows still
    missing come one each from the classes with the largest fractions, the lower label first.
    The window sees one row per class.
    """
    total = F.sum("n").over(W.partitionBy())
    train = total - F.ceil(total * F.lit(test_fraction)).cast("bigint")
    # In whole numbers, as a quotient of doubles may fall short of the next integer.
    whole = F.expr("(n * train) div total")
    left = F.col("n") * F.col("train") - F.col("total") * F.col("whole")
    missing = F.col("train") - F.sum("whole").over(W.partitionBy())
    turn = F.row_number().over(W.partitionBy().orderBy(F.desc("left"), label))
    return (
        by_class.withColumns({"total": total, "train": train})
        .withColumn("whole", whole)
        .withColumn("left", left)
        .select(
            label,
            (F.col("n") - F.col("whole") - F.when(turn <= missing, 1).otherwise(0)).alias(
                "test_n"
            ),
        )
    )


def stratified_split(
    df: DataFrame,
    test_fraction: float = 0.2,
    seed: int = 42,
    label: str = LABEL,
    key: str = KEY,
    bucket_digits: int = 3,
) -> DataFrame:
    """Add ``split`` = train/test, ``ceil(test_fraction * rows)`` test rows in all, label shares kept.

    Rows are ordered by a hash of their key and the first ``test_fraction`` of each class
    is the test set. Ranking a class outright would put half the data into one task, so
    the cut is located like a number in a drawer: counts per leading hash digits give the
    bucket it falls in, the next digits narrow it down within that bucket, and only the
    few keys left are ranked. The result is one cut value per class (hence the
    broadcasts: two rows each), and the split itself is a comparison.
    Rows without a label or key belong to neither side and are left out.
    """
    hashed = (
        df.filter(F.col(label).isNotNull() & F.col(key).isNotNull())
        .withColumn("key_hash", F.md5(F.concat(F.col(key), F.lit(str(seed)))))
        .withColumn("bucket", F.substring("key_hash", 1, bucket_digits))
    )
    by_bucket = hashed.groupBy(label, "bucket").agg(F.count("*").alias("n"))
    by_class = by_bucket.groupBy(label).agg(F.sum("n").alias("n"))
    sizes = split_sizes(by_class, label, test_fraction)
    cut_bucket = where_running_total_reaches(
        by_bucket.join(F.broadcast(sizes), label), label, ["bucket"], "test_n"
    )
    keys = (
        hashed.select(label, key, "key_hash", "bucket")
        .transform(lambda rows: match(rows, cut_bucket, label, "bucket"))
        .groupBy(label, "key_hash", key, "still_needed")
        .agg(F.count("*").alias("n"))
        .withColumn("part", F.substring("key_hash", bucket_digits + 1, bucket_digits))
    )
    by_part = keys.groupBy(label, "part", "still_needed").agg(F.sum("n").alias("n"))
    cut_part = where_running_total_reaches(by_part, label, ["part"], "still_needed")
    last_keys = match(keys.drop("still_needed"), cut_part, label, "part")
    cut = where_running_total_reaches(
        last_keys, label, ["key_hash", key], "still_needed"
    ).select(label, F.struct("key_hash", key).alias("cut"))
    is_test = F.struct("key_hash", key) <= F.col("cut")
    return (
        hashed.join(F.broadcast(cut), label, "left")
        .withColumn("split", F.when(is_test, "test").otherwise("train"))
        .select(*df.columns, "split")
    )


def class_weight(label: Column, n: int, n_positive: int) -> Column:
    """Balanced weights: rows / (2 x rows of the class)."""
    weight = F.when(label == 1, F.lit(n / (2.0 * n_positive)) if n_positive else F.lit(1.0))
    negatives = n - n_positive
    return weight.otherwise(F.lit(n / (2.0 * negatives)) if negatives else F.lit(1.0))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """The balanced weight of each class as a table."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(label, "n", (total / (F.lit(2.0) * F.col("n"))).alias("class_weight"))


def numeric_scaling() -> PopulationScaler:
    """Fitting sees complete rows only; prediction leaves the others without a figure."""
    return PopulationScaler(inputCols=NUMERIC_FEATURES, outputCol="scaled")


def category_encoding() -> list:
    """Alphabetical slots for all known values; a value not seen in training is all zeros."""
    indexed = [f"{c}_index" for c in CATEGORICAL_FEATURES]
    return [
        StringIndexer(
            inputCols=CATEGORICAL_FEATURES,
            outputCols=indexed,
            stringOrderType="alphabetAsc",
            handleInvalid="keep",
        ),
        OneHotEncoder(
            inputCols=indexed, outputCols=[f"{c}_slots" for c in CATEGORICAL_FEATURES]
        ),
    ]


def preprocessing() -> Pipeline:
    slots = [f"{c}_slots" for c in CATEGORICAL_FEATURES]
    # The assembler asks the first row for a size that is not declared; a stream has none.
    size = VectorSizeHint(
        inputCol="scaled", size=len(NUMERIC_FEATURES), handleInvalid="optimistic"
    )
    assembled = VectorAssembler(inputCols=["scaled", *slots], outputCol="features")
    return Pipeline(stages=[numeric_scaling(), size, *category_encoding(), assembled])


def standardised_numerics(features: DataFrame) -> DataFrame:
    """Each numeric feature as a z-score with the population deviation.

    The same stage as in the fitted models. Fitting passes over ``features`` again, so give it
    a stored table. A single row has deviation zero and z-scores of zero.
    """
    features = complete(features)
    scores = numeric_scaling().fit(features).z_scores()
    return features.select(KEY, *[z.alias(f"z_{c}") for z, c in zip(scores, NUMERIC_FEATURES)])


def category_slots(features: DataFrame) -> DataFrame:
    """For each categorical feature: its values, their slots and how often a slot is set."""
    indexer, encoder = category_encoding()
    index_model = indexer.fit(features)
    indexed = index_model.transform(features)
    encoded = encoder.fit(indexed).transform(indexed)
    # One row per feature of a payment, whatever the vocabulary; the slot is where the one is.
    cells = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(c).alias("value"),
                (F.array_position(vector_to_array(f"{c}_slots"), 1.0) - 1)
                .cast("int")
                .alias("slot"),
            )
            for c in CATEGORICAL_FEATURES
        ]
    )
    return (
        encoded.select(F.inline(cells))
        .filter("slot >= 0")
        .groupBy("feature", "value", "slot")
        .agg(F.count("*").alias("rows_set"))
    )


def feature_vectors(features: DataFrame) -> DataFrame:
    """The assembled vector of every row, with its width and how many slots are set.

    Fitting passes over ``features`` again, so give it a stored table.
    """
    features = complete(features)
    ready = preprocessing().fit(features).transform(features)
    values = vector_to_array("features")
    slots = F.slice(values, len(NUMERIC_FEATURES) + 1, F.size(values))
    return ready.select(
        KEY,
        "features",
        F.size(values).alias("vector_size"),
        F.size(F.filter(slots, lambda x: x != 0)).alias("slots_set"),
    )
