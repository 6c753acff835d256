"""The whole batch: raw payments to stored tables, reports and exports.

The fact rows are shuffled once (duplicate removal) and written once, already scored.
The unscored table is a view over the same files. All report grains then come from one
scan of the stored columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from riskledger.models.training import ModelSizes, store_training, train
from riskledger.operators.cleaning import clean_payments
from riskledger.operators.quality import cleaning_counters, null_profile, overall_rates
from riskledger.operators.scoring import score_transactions, top_risk_transactions
from riskledger.plans.marts import EXPORT_ORDER, MARTS
from riskledger.plans.questions import QUESTIONS, RISK_LEVELS
from riskledger.plans.rollup import Report, kpi_rollup
from riskledger.schema import CLEAN_COLUMNS, MART_NAMES, SCORED, TRANSACTIONS
from riskledger.sinks import export_tables, replace_table, write_report_csv

ROLLUP = "kpi_rollup"


def load_transactions(
    spark: SparkSession,
    raw: DataFrame,
    location: str | None = None,
    partition_by: Iterable[str] = (),
) -> DataFrame:
    """Clean, score and store the payments; registers both transaction tables.

    Partitioning (by year and month, say) costs one more shuffle and pays off only where
    readers filter on those columns.
    """
    scored = score_transactions(clean_payments(raw))
    stored = replace_table(scored, SCORED, location and f"{location}/{SCORED}", partition_by)
    spark.sql(
        f"CREATE OR REPLACE VIEW {TRANSACTIONS} AS SELECT {', '.join(CLEAN_COLUMNS)} FROM {SCORED}"
    )
    return stored


def build_rollup(spark: SparkSession, location: str | None = None) -> DataFrame:
    """One pass over the stored payments, kept as a small table."""
    return replace_table(
        kpi_rollup(spark.table(SCORED)), ROLLUP, location and f"{location}/{ROLLUP}"
    )


def together(actions: Iterable[Callable[[], object]]) -> list:
    """Run independent small jobs at the same time, so that they fill the cluster."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        return [done.result() for done in [pool.submit(action) for action in actions]]


def build_marts(
    spark: SparkSession, location: str | None = None, from_rollup: bool = True
) -> dict[str, DataFrame]:
    """The four reporting tables, from the stored rollup or each from its own scan.

    Four scans of a few columns each cost less processor time than the rollup; the
    rollup pays off once the questions and risk levels are read from it too.
    """

    def build(name: str, report: Report) -> DataFrame:
        if from_rollup:
            mart = report.unsorted().over_rollup(spark.table(ROLLUP))
        else:
            mart = report.unsorted().over_payments(spark.table(TRANSACTIONS))
        return replace_table(mart, name, location and f"{location}/{name}")

    tables = together([lambda n=n, r=r: build(n, r) for n, r in MARTS.items()])
    return dict(zip(MARTS, tables))


def run_questions(
    spark: SparkSession,
    folder: str | None = None,
    questions: Mapping[str, Report | str] = QUESTIONS,
    from_rollup: bool = True,
) -> dict[str, DataFrame]:
    """Answer named questions: reports, or SQL text over the stored tables.

    With a folder, every answer is also written to ``folder/name`` as CSV.
    """
    answers = {}
    for name, question in questions.items():
        if isinstance(question, str):
            answers[name] = spark.sql(question)
        elif from_rollup:
            answers[name] = question.over_rollup(spark.table(ROLLUP))
        else:
            answers[name] = question.over_payments(spark.table(TRANSACTIONS))
    if folder:
        write_reports(answers, folder)
    return answers


def write_reports(reports: Mapping[str, DataFrame], folder: str) -> None:
    together(
        [lambda n=n, r=r: write_report_csv(r, f"{folder}/{n}") for n, r in reports.items()]
    )


def risk_reports(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Risk levels (from the rollup) and the riskiest payments, written as CSV."""
    reports = {
        "risk_level_summary": RISK_LEVELS.over_rollup(spark.table(ROLLUP)),
        "top_risk_transactions": top_risk_transactions(spark.table(SCORED)),
    }
    write_reports(reports, folder)
    return reports


def cleaning_reports(
    spark: SparkSession, raw: DataFrame, folder: str, quarantined: DataFrame | None = None
) -> dict[str, DataFrame]:
    """What cleaning removed and what is left, written as CSV."""
    clean = spark.table(TRANSACTIONS)
    reports = {
        "cleaning_counters": cleaning_counters(raw, quarantined, clean),
        "null_profile": null_profile(clean),
        "overall_rates": overall_rates(clean),
    }
    write_reports(reports, folder)
    return reports


def train_models(
    spark: SparkSession, location: str, folder: str, sizes: ModelSizes | None = None
) -> dict[str, DataFrame]:
    """Fit, compare and store the classifiers over the stored payments; tables also as CSV."""
    tables = store_training(train(spark.table(TRANSACTIONS), sizes), location)
    write_reports(tables, folder)
    return tables


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    reports: str,
    location: str | None = None,
    exports: Iterable[str] = MART_NAMES,
    quarantined: DataFrame | None = None,
    models: str | None = None,
    sizes: ModelSizes | None = None,
) -> dict[str, DataFrame]:
    """Load, build marts, export them, answer every question, write all reports.

    With a folder for ``models``, classifiers are trained and stored there too.
    """
    load_transactions(spark, raw, location)
    build_rollup(spark, location)
    build_marts(spark, location)
    export_tables(spark, exports, reports, EXPORT_ORDER)
    answers = run_questions(spark, f"{reports}/sql_outputs")
    answers |= risk_reports(spark, reports)
    answers |= cleaning_reports(spark, raw, reports, quarantined)
    if models:
        answers |= train_models(spark, models, f"{reports}/model_results", sizes)
    return answers
