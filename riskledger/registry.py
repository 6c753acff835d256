"""Every query by name: ``(spark, folder of tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskledger.functions.display import timestamp_text
from riskledger.models import certificates, tables
from riskledger.models import features as mf
from riskledger.models import metrics as mm
from riskledger.models import training as mt
from riskledger.operators import cleaning, merchants, quality, scoring, slices
from riskledger.operators import spikes as sp
from riskledger.operators.ranking import first_rows
from riskledger.plans import batch, marts, questions
from riskledger.plans.rollup import kpi_rollup
from riskledger.schema import (
    DAILY,
    FAILURE,
    HOURLY,
    MART_NAMES,
    MERCHANT,
    RAW_COLUMNS,
    SCORED,
    TRANSACTIONS,
)
from riskledger.session import materialise, temporary_folder
from riskledger.sinks import (
    export_tables,
    list_tables,
    replace_table,
    table_row_counts,
    write_csv,
    write_report_csv,
)
from riskledger.sources import payments_from_events, read_payments_csv, scan_payments_csv
from riskledger.streaming.payments import read_payment_stream, write_stream
from riskledger.streaming.spikes import current_spikes, write_window_counts

Query = Callable[[SparkSession, str], DataFrame]

#: Columns that name a row of a report.
REPORT_KEYS = {
    DAILY: ["transaction_date"],
    MERCHANT: ["merchant_id", "merchant_category"],
    FAILURE: ["failure_reason"],
    HOURLY: ["hour"],
    "executive_payment_kpis": [],
    "daily_payment_trend": ["transaction_date"],
    "top_failure_reasons": ["failure_reason"],
    "high_risk_merchants": ["merchant_id", "merchant_category"],
    "fraud_by_channel": ["channel"],
    "chargeback_by_category": ["merchant_category"],
    "weekend_vs_weekday_risk": ["day_type"],
    "slow_response_impact": ["response_type"],
    "high_value_risk": ["transaction_value_type"],
    "payment_method_performance": ["payment_method"],
    "monthly_risk_trend": ["month"],
    "location_based_risk": ["customer_location"],
}

def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payments_from_events(spark, sf_dir)


def unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_exact_duplicates(raw(spark, sf_dir))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_payments(raw(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.score_transactions(txn(spark, sf_dir))


def over(source: Query, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    """A query that applies DataFrame functions to a source."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = source(spark, sf_dir)
        for step in steps:
            df = step(df)
        return dates_as_text(df)

    return run


def dates_as_text(df: DataFrame) -> DataFrame:
    """ISO text for the date column, the form in which reports are compared and exported."""
    if "transaction_date" not in df.columns:
        return df
    return df.withColumn("transaction_date", F.col("transaction_date").cast("string"))


def travel_online(df: DataFrame) -> DataFrame:
    return slices.slice_payments(df, merchant_category="Travel", channel="Online")


# Sources, sinks and tables.


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = temporary_folder(spark, "raw-csv")
    write_csv(raw(spark, sf_dir), path)
    return read_payments_csv(spark, path)


def damaged_csv(spark: SparkSession, sf_dir: str) -> str:
    """The payments as CSV in which cells of some transactions can't be read or are missing."""
    path = temporary_folder(spark, "damaged-csv")
    ends = F.col("transaction_id").endswith
    text = raw(spark, sf_dir).select([F.col(c).cast("string").alias(c) for c in RAW_COLUMNS])
    amount, at, ms = "transaction_amount", "transaction_datetime", "processor_response_ms"
    damaged = text.withColumns(
        {
            amount: F.when(ends("5") | ends("77"), "12,5x")
            .when(ends("3"), "n/a")
            .otherwise(F.col(amount)),
            at: F.when(ends("7"), "yesterday").otherwise(F.col(at)),
            ms: F.when(ends("9"), "NA").otherwise(F.col(ms)),
        }
    )
    write_csv(damaged, path)
    return path


def quarantined_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, quarantined = scan_payments_csv(spark, damaged_csv(spark, sf_dir))
    return quarantined.groupBy(
        "transaction_id", F.array_join("unreadable", ",").alias("unreadable")
    ).agg(F.count("*").alias("copies"))


def damaged_csv_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments, quarantined = scan_payments_csv(spark, damaged_csv(spark, sf_dir))
    return quality.cleaning_counters(payments, quarantined)


def csv_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = marts.MARTS[DAILY].over_payments(txn(spark, sf_dir))
    path = temporary_folder(spark, "report-csv")
    write_report_csv(report, path)
    return dates_as_text(spark.read.schema(report.schema).option("header", True).csv(path))


def replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    payments = txn(spark, sf_dir)
    path = temporary_folder(spark, "clean")
    stored = replace_table(payments, "clean_payments_copy", path, ["year", "month"])
    return dates_as_text(stored.select(*payments.columns))


def loaded(spark: SparkSession, sf_dir: str) -> str:
    location = temporary_folder(spark, "tables")
    batch.load_transactions(spark, raw(spark, sf_dir), location)
    batch.build_rollup(spark, location)
    return location


def load_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the tables the batch makes, as the catalogue lists them."""
    batch.build_marts(spark, loaded(spark, sf_dir))
    made = [TRANSACTIONS, SCORED, *MART_NAMES]
    return table_row_counts(spark, [t for t in list_tables(spark) if t in made])


def figures_of(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """(table_name, row_key, column_name, number): every figure of a report, one per row."""
    numbers = [c for c in df.columns if c not in keys and dict(df.dtypes)[c] != "string"]
    row_key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return (
        df.select(row_key.alias("row_key"), *[F.col(c).cast("double").alias(c) for c in numbers])
        .unpivot("row_key", numbers, "column_name", "number")
        .select(F.lit(name).alias("table_name"), "row_key", "column_name", "number")
    )


def read_back(spark: SparkSession, reports: dict[str, tuple[str, T.StructType]]) -> DataFrame:
    """The figures of reports as their CSV files have them."""
    parts = []
    for name, (path, schema) in reports.items():
        df = spark.read.schema(schema).option("header", True).csv(path)
        parts.append(figures_of(name, df, REPORT_KEYS[name]))
    return reduce(DataFrame.unionByName, parts)


def exported_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four reporting tables, stored, exported as CSV and read back."""
    built = batch.build_marts(spark, loaded(spark, sf_dir), from_rollup=False)
    folder = temporary_folder(spark, "exports")
    written = export_tables(spark, MART_NAMES, folder, marts.EXPORT_ORDER)
    return read_back(spark, {n: (path, built[n].schema) for n, path in written.items()})


def named_questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The answers to all named questions, written as CSV and read back."""
    loaded(spark, sf_dir)
    folder = temporary_folder(spark, "answers")
    answers = batch.run_questions(spark, folder)
    return read_back(spark, {n: (f"{folder}/{n}", df.schema) for n, df in answers.items()})


def from_rollup(table: str) -> Query:
    return over(scored, kpi_rollup, marts.MARTS[table].over_rollup)


def mart(name: str, *steps: Callable[[DataFrame], DataFrame]) -> Query:
    return over(txn, marts.MARTS[name].over_payments, *steps)


def question(name: str) -> Query:
    return over(txn, questions.QUESTIONS[name].over_payments)


def cached_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several slices read from one kept copy of the scored payments."""
    out = temporary_folder(spark, "slices")
    with slices.cached_payments(scored(spark, sf_dir)) as kept:
        for channel in ("Online", "In-Store", "Mobile App"):
            slices.slice_payments(kept, channel=channel).groupBy("channel", "risk_level").agg(
                F.count("*").alias("transactions")
            ).write.mode("append").parquet(out)
    return spark.read.parquet(out)


# Cleaning.


def timestamp_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = unique(spark, sf_dir).select(
        "transaction_id", timestamp_text("transaction_datetime").alias("transaction_datetime")
    )
    return cleaning.parse_timestamp(text)


def time_features(df: DataFrame) -> DataFrame:
    names = ["transaction_date", "hour", "day_of_week", "month", "year", "is_weekend"]
    return cleaning.add_time_features(df).select("transaction_id", *names)


def threshold_flags(df: DataFrame) -> DataFrame:
    names = ["is_failed", "high_value_txn", "slow_response"]
    return cleaning.add_threshold_flags(df).select("transaction_id", *names)


def datetime_text(df: DataFrame) -> DataFrame:
    return df.select(
        "transaction_id",
        timestamp_text("transaction_datetime").alias("transaction_datetime"),
        F.col("transaction_date").cast("string").alias("transaction_date"),
    )


def tier_sizes(merchant_summary: DataFrame) -> DataFrame:
    return (
        merchant_summary.groupBy("merchant_risk_level")
        .agg(F.count("*").alias("merchants"))
        .orderBy("merchant_risk_level")
    )


# Models.


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mf.feature_frame(txn(spark, sf_dir))


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features behind one cleaning shuffle, however often they are passed over."""
    return materialise(features(spark, sf_dir), temporary_folder(spark, "features"))


def rounded_zscores(df: DataFrame) -> DataFrame:
    z = mf.standardised_numerics(df)
    # Adding zero turns a rounded negative zero into zero.
    return z.select(
        mf.KEY, *[(F.round(c, 6) + F.lit(0.0)).alias(c) for c in z.columns if c != mf.KEY]
    )


def weights_of_training_rows(df: DataFrame) -> DataFrame:
    return mf.class_weights(mf.stratified_split(df).filter(F.col("split") == "train"))


def rule_prediction(df: DataFrame, floor: int = 50) -> DataFrame:
    return df.select(
        F.col("is_fraud").alias("label"),
        (F.col("risk_score") >= floor).cast("int").alias("prediction"),
    )


def rule_model_metrics(df: DataFrame) -> DataFrame:
    """The rule score at four floors, judged as if each were a classifier."""
    floors = {
        "Critical only": 75,
        "High and above": 50,
        "Medium and above": 25,
        "Any points at all": 1,
    }
    return mm.binary_metrics(
        df, [(name, (F.col("risk_score") >= f).cast("int")) for name, f in floors.items()]
    )


def roc_auc_rules(df: DataFrame) -> DataFrame:
    both = scoring.score_in_flight(df)
    return mm.roc_auc(both, {"post_txn": "risk_score", "pre_txn": "pre_txn_risk_score"})


def feature_list(df: DataFrame) -> DataFrame:
    """The feature manifest with the number of rows that have each feature."""
    present = df.agg(*[F.count(c).alias(c) for c in mf.FEATURES])
    rows = present.unpivot([], mf.FEATURES, "feature", "rows_present")
    return mf.feature_manifest(df.sparkSession).join(rows, "feature")


def feature_vector_shape(df: DataFrame) -> DataFrame:
    return mf.feature_vectors(df).drop("features")


_trained: dict[tuple, dict[str, mt.TrainingResult]] = {}


def stamp(spark: SparkSession, sf_dir: str, table: str) -> tuple:
    """Names, sizes and times of a table's files: another table has another stamp."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{table}.parquet")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return tuple(
        sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path))
    )


def trained(
    spark: SparkSession,
    sf_dir: str,
    with_outcomes: bool = False,
    names: Sequence[str] = mt.NAMES[:3],
) -> mt.TrainingResult:
    """Candidates of the ML library at full size; each once per session, table and feature set."""
    key = (spark.sparkContext.applicationId, stamp(spark, sf_dir, "events"), with_outcomes)
    known = _trained.setdefault(key, {})
    if missing := [name for name in names if name not in known]:
        result = mt.train(txn(spark, sf_dir), with_outcomes=with_outcomes, only=missing)
        known |= {name: mt.of_model(result, name) for name in missing}
    return mt.together([known[name] for name in names])


def exact_figures(result: mt.TrainingResult) -> DataFrame:
    """What must hold of a comparison whatever the classifiers make of the data.

    Training and judged rows per model and class, and whether all metrics are in their range.
    """
    sizes = result.split_sizes.groupBy("label").pivot("split", ["train", "test"]).sum("n")
    judged = result.confusion.groupBy("model", "label").agg(
        F.sum("transactions").alias("judged_rows")
    )
    metrics = [*mm.METRICS, "roc_auc"]
    fair = F.forall(F.array(*metrics), lambda x: (x >= 0) & (x <= 1))
    ranges = result.comparison.select("model", fair.alias("metrics_in_range"))
    return (
        judged.join(sizes, "label")
        .join(ranges, "model")
        .select(
            "model",
            "label",
            F.col("train").alias("train_rows"),
            F.col("test").alias("test_rows"),
            "judged_rows",
            "metrics_in_range",
        )
    )


def fitted(name: str) -> Query:
    """One candidate of the comparison."""
    return lambda spark, sf_dir: exact_figures(trained(spark, sf_dir, names=[name]))


def model_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_figures(trained(spark, sf_dir))


def model_comparison_with_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_figures(trained(spark, sf_dir, with_outcomes=True))


def model_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per true class of each model's confusion matrix, read from the stored table."""
    stored = mt.store_training(trained(spark, sf_dir), temporary_folder(spark, "models"))
    return (
        stored["model_confusion"].groupBy("model", "label")
        .agg(F.sum("transactions").alias("transactions"))
    )


def model_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes, averages and support of each model's report, read from the stored table."""
    stored = mt.store_training(trained(spark, sf_dir), temporary_folder(spark, "models"))
    return stored["model_report"].select("model", "class", "support")


def batch_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every payment scored by the chosen model, stored and loaded again.

    ``consistent`` tells whether the class goes by the probability.
    """
    path = temporary_folder(spark, "model")
    mt.save_model(trained(spark, sf_dir).best, path)
    probability = F.col("fraud_probability")
    return mt.predict(mt.load_model(path), txn(spark, sf_dir)).select(
        mf.KEY,
        "risk_score",
        "rule_risk_level",
        (
            probability.between(0, 1)
            & ((F.col("fraud_prediction") == 1) == (probability > 0.5))
        ).alias("consistent"),
    )


def fitted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of the fitted candidates on the test rows. They vary with the platform: no SQL."""
    return trained(spark, sf_dir).comparison


def fitted_confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of the fitted candidates' confusion matrices."""
    return trained(spark, sf_dir).confusion


def fitted_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Precision, recall and F1 of the fitted candidates per class, and their averages."""
    return trained(spark, sf_dir).report


def fitted_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and probability of every payment by the chosen model, stored and loaded again."""
    path = temporary_folder(spark, "model")
    mt.save_model(trained(spark, sf_dir).best, path)
    return mt.predict(mt.load_model(path), txn(spark, sf_dir))


def model_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the chosen model learned, as rows."""
    return tables.model_table(spark, trained(spark, sf_dir).best)


def table_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every complete payment scored by the chosen model's table, without its classes."""
    parameters = tables.model_table(spark, trained(spark, sf_dir).best)
    return tables.score(parameters, mf.complete(features(spark, sf_dir)), mf.KEY)


def model_certificates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the fitted candidates are optimal by their own mathematics."""
    result = trained(spark, sf_dir)
    split = mf.stratified_split(mf.complete(features(spark, sf_dir)))
    # A fit is optimal over its own rows and no others: all that are marked train.
    rows = materialise(
        mt.fitted_rows(split, result.split_sizes).drop("split"),
        temporary_folder(spark, "train-rows"),
    )
    return certificates.certificates(result.models, rows).select(
        "model", "certificate", "holds"
    )


#: Rounds of the registered query; the library's own default is the published 250, which takes
#: as many times longer, whatever the number of rows.
SECOND_ORDER_ROUNDS = 40


def second_order_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of trees boosted by second derivatives, on the full split."""
    sizes = mt.ModelSizes(second_order_rounds=SECOND_ORDER_ROUNDS)
    return mt.train(txn(spark, sf_dir), sizes, only=[mt.SECOND_ORDER]).comparison


def roc_auc_ranked(df: DataFrame) -> DataFrame:
    """The areas of ``roc_auc_rules`` by the way continuous scores take."""
    both = scoring.score_in_flight(df)
    return mm.roc_auc_scores(both, {"post_txn": "risk_score", "pre_txn": "pre_txn_risk_score"})


def streamed_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments arriving as files, cleaned and scored by the streaming operators."""
    arriving = temporary_folder(spark, "arriving")
    raw(spark, sf_dir).repartition(8).write.parquet(arriving)
    out = temporary_folder(spark, "stream") + "/scored"
    write_stream(read_payment_stream(spark, arriving, files_per_batch=3), out).awaitTermination()
    return dates_as_text(spark.read.parquet(out).drop("batch"))


def spike_alerts(df: DataFrame) -> DataFrame:
    found = sp.spikes(sp.window_counts(df))
    return found.withColumn("window_start", F.col("window_start").cast("string"))


def streamed_spike_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``spike_alerts`` of payments that arrive as files in no order of time."""
    arriving = temporary_folder(spark, "arriving")
    raw(spark, sf_dir).repartition(8).write.parquet(arriving)
    out = temporary_folder(spark, "stream") + "/counts"
    stream = read_payment_stream(spark, arriving, files_per_batch=3)
    write_window_counts(stream, out).awaitTermination()
    found = current_spikes(spark, out)
    return found.withColumn("window_start", F.col("window_start").cast("string"))


QUERIES: dict[str, Query] = {
    # Sources, sinks and tables.
    "csv_scan": csv_scan,
    "csv_sink": csv_sink,
    "replaced_table": replaced_table,
    "load_validation": load_validation,
    "exported_tables": exported_tables,
    "named_questions": named_questions,
    "merchant_mart_from_rollup": from_rollup(MERCHANT),
    "daily_mart_from_rollup": from_rollup(DAILY),
    "cached_slices": cached_slices,
    # Cleaning and profiling.
    "exact_dedup": unique,
    "timestamp_parse": timestamp_parse,
    "null_fill": over(unique, cleaning.fill_missing),
    "positive_amounts": over(unique, cleaning.keep_positive_amounts),
    "valid_statuses": over(unique, cleaning.keep_valid_statuses),
    "cleaning_counters": over(raw, quality.cleaning_counters),
    "quarantined_rows": quarantined_rows,
    "damaged_csv_counters": damaged_csv_counters,
    "null_profile_raw": over(raw, quality.null_profile),
    "null_profile_clean": over(txn, quality.null_profile),
    "time_features": over(unique, time_features),
    "threshold_flags": over(unique, threshold_flags),
    "clean_payments": over(txn),
    "datetime_text": over(txn, datetime_text),
    "report_columns": over(scored, lambda df: df.select(*scoring.TOP_RISK_COLUMNS)),
    "failed_payments": over(txn, marts.failed_payments),
    "high_risk_merchant_rows": mart(MERCHANT, merchants.only_high_risk),
    "payment_slice": over(scored, travel_online),
    "payment_slice_all": over(
        scored, lambda df: slices.slice_payments(df, slices.ALL, slices.ALL, slices.ALL)
    ),
    "transaction_preview": over(scored, travel_online, slices.transaction_preview),
    # Reporting tables and business questions.
    DAILY: mart(DAILY),
    MERCHANT: mart(MERCHANT),
    FAILURE: mart(FAILURE),
    HOURLY: mart(HOURLY),
    "merchant_risk_tier": mart(MERCHANT, tier_sizes),
    "executive_payment_kpis": question("executive_payment_kpis"),
    "daily_payment_trend": question("daily_payment_trend"),
    "top_failure_reasons": question("top_failure_reasons"),
    "fraud_by_channel": question("fraud_by_channel"),
    "chargeback_by_category": question("chargeback_by_category"),
    "weekend_vs_weekday_risk": question("weekend_vs_weekday_risk"),
    "slow_response_impact": question("slow_response_impact"),
    "high_value_risk": question("high_value_risk"),
    "payment_method_performance": question("payment_method_performance"),
    "monthly_risk_trend": question("monthly_risk_trend"),
    "location_based_risk": question("location_based_risk"),
    "high_risk_merchants": mart(MERCHANT, merchants.high_risk_merchants),
    "high_risk_merchants_dashboard": mart(MERCHANT, merchants.high_risk_merchants_dashboard),
    "merchant_top5": mart(MERCHANT, merchants.merchant_top5),
    # Risk scoring.
    "score_transactions": over(scored),
    "risk_score": over(scored, lambda df: df.select("transaction_id", "risk_score")),
    "risk_level": over(scored, lambda df: df.select("transaction_id", "risk_level")),
    "risk_reason": over(scored, lambda df: df.select("transaction_id", "risk_reason")),
    "pre_txn_risk_score": over(
        txn,
        scoring.score_in_flight,
        lambda df: df.select("transaction_id", "pre_txn_risk_score", "pre_txn_risk_level"),
    ),
    "risk_level_summary": over(scored, scoring.risk_level_summary),
    "top_risk_transactions": over(scored, scoring.top_risk_transactions),
    "top_risk_preview": over(
        scored,
        scoring.top_risk_transactions,
        lambda df: first_rows(df, 10, F.desc("risk_score"), "transaction_id"),
    ),
    "daily_trend_preview": over(
        txn,
        questions.QUESTIONS["daily_payment_trend"].over_payments,
        lambda df: first_rows(df, 5, "transaction_date"),
    ),
    # Dashboard slices.
    "slice_kpis": over(scored, travel_online, slices.slice_kpis),
    "slice_kpi_cards": over(scored, travel_online, slices.slice_kpi_cards),
    "slice_fraud_by_channel": over(
        scored,
        lambda df: slices.slice_payments(df, payment_method="Credit Card"),
        slices.slice_fraud_by_channel,
    ),
    "slice_hourly_fraud": over(
        scored,
        lambda df: slices.slice_payments(df, channel="Mobile App"),
        slices.slice_hourly_fraud,
    ),
    "slice_failure_counts": over(scored, travel_online, slices.slice_failure_counts),
    "slice_risk_distribution": over(scored, travel_online, slices.slice_risk_distribution),
    "distinct_values": over(
        raw,
        cleaning.repair_and_derive,
        lambda df: quality.distinct_values(df, slices.OPTION_COLUMNS),
    ),
    # Whole-table figures.
    "target_distribution": over(txn, quality.label_shares),
    "overall_rates": over(txn, quality.overall_rates),
    "raw_status_counts": over(raw, quality.raw_status_counts),
    "raw_outcome_rates": over(raw, quality.raw_outcome_rates),
    # Model preparation and evaluation.
    "model_feature_rows": features,
    "model_feature_list": over(features, feature_list),
    "stratified_split": over(
        txn,
        mf.stratified_split,
        lambda df: df.select("transaction_id", "is_fraud", "split"),
    ),
    "standardised_numerics": over(stored_features, rounded_zscores),
    "category_slots": over(stored_features, mf.category_slots),
    "feature_vectors": over(stored_features, feature_vector_shape),
    "class_weights": over(txn, weights_of_training_rows),
    "roc_auc_rules": over(scored, roc_auc_rules),
    "roc_auc_ranked": over(scored, roc_auc_ranked),
    "rule_model_metrics": over(scored, rule_model_metrics),
    "best_rule_model": over(scored, rule_model_metrics, mm.best_by_recall),
    "confusion_matrix": over(scored, rule_prediction, mm.confusion_matrix),
    "classification_report": over(scored, rule_prediction, mm.classification_report),
    # Fitted models and streams.
    "logistic_regression": fitted("Logistic Regression"),
    "random_forest": fitted("Random Forest"),
    "gradient_boosted_trees": fitted("Gradient Boosted Trees"),
    "model_comparison": model_comparison,
    "model_comparison_with_outcomes": model_comparison_with_outcomes,
    "model_confusion": model_confusion,
    "model_report": model_report,
    "batch_predictions": batch_predictions,
    "fitted_metrics": fitted_metrics,
    "fitted_confusion": fitted_confusion,
    "fitted_report": fitted_report,
    "fitted_predictions": fitted_predictions,
    "model_parameters": model_parameters,
    "table_predictions": table_predictions,
    "model_certificates": model_certificates,
    "second_order_boosting": second_order_boosting,
    "streamed_scores": streamed_scores,
    "spike_alerts": over(txn, spike_alerts),
    "streamed_spike_alerts": streamed_spike_alerts,
}
