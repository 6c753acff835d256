import csv
import datetime as dt
import glob
import threading
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from riskledger.plans import batch
from riskledger.registry import raw
from riskledger.schema import MART_NAMES, RAW_COLUMNS, SCORED, TRANSACTIONS
from riskledger.session import materialise, remove_folder, shared_folder, shared_root
from riskledger.sinks import list_tables, replace_table, table_row_counts, write_csv
from riskledger.sources import read_payments_csv, scan_payments_csv
from riskledger.sources.events import padded_id
from riskledger.streaming.payments import read_payment_stream, write_stream


def test_csv_as_a_plain_exporter_writes_it(spark, tmp_path):
    path = tmp_path / "payments.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(RAW_COLUMNS)
        head = ["TXN00000001", "CUST000001", "MERCH00001", "2024-01-01 10:20:30"]
        how = ["ACH", "Online", "Tablet"]
        out.writerow([*head, "49.95", *how, "", "", "Approved", "None", "90", "0", "1"])
        out.writerow([*head, "", *how, "Fuel", "TX", "Failed", "Expired Card", "90", "0", "0"])
    first, second = read_payments_csv(spark, str(path)).collect()
    assert first.transaction_datetime == dt.datetime(2024, 1, 1, 10, 20, 30)
    assert (first.transaction_amount, first.is_chargeback) == (49.95, 1)
    assert first.merchant_category is first.customer_location is first.failure_reason is None
    assert second.transaction_amount is None
    assert second.failure_reason == "Expired Card"


def test_unreadable_values_are_quarantined_or_stop_the_job(spark, tmp_path):
    path = tmp_path / "bad.csv"
    start = ["T", "C", "M", "not a time", "x", "ACH", "Online", "Tablet", "#N/A", "NULL"]
    good = ["U", "C", "M", "2024-01-01 10:20:30", "1.5", *start[5:]]
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows(
            [
                RAW_COLUMNS,
                [*start, "Approved", "None", "90", "0", "1"],
                [*good, "Approved", "None", "NA", "0", "1"],
                [*good, "Approved", "None", "90.0", "0", "1.5"],
                [*good, "Approved", "None", " 90.0 ", "0", "1"],
            ]
        )
    payments, quarantined = scan_payments_csv(spark, str(path))
    missing, read = payments.orderBy("processor_response_ms").collect()
    assert missing.processor_response_ms is None
    assert read.merchant_category is read.customer_location is None
    assert read.processor_response_ms == 90
    found = {r.transaction_id: r for r in quarantined.collect()}
    assert found["T"].unreadable == ["transaction_datetime", "transaction_amount"]
    assert found["U"].unreadable == ["is_chargeback"]
    assert found["T"].transaction_amount == "x"
    assert read_payments_csv(spark, str(path)).count() == 2
    with pytest.raises(Exception, match="unreadable payment cells"):
        read_payments_csv(spark, str(path), mode="FAILFAST").collect()


def test_missing_value_text_is_accepted_in_both_modes(spark, tmp_path):
    path = tmp_path / "missing.csv"
    row = ["T", "C", "M", "2024-01-01 10:20:30", "NA", "ACH", "Online", "Tablet", "Fuel", "TX"]
    with open(path, "w", newline="") as f:
        csv.writer(f).writerows([RAW_COLUMNS, [*row, "Approved", "None", "n/a", "NaN", "1"]])
    for mode in ("PERMISSIVE", "FAILFAST"):
        read = read_payments_csv(spark, str(path), mode=mode).first()
        assert read.transaction_amount is read.processor_response_ms is read.is_fraud is None


def test_csv_round_trip_keeps_microseconds(spark, payments, tmp_path):
    at = dt.datetime(2024, 5, 6, 7, 8, 9, 123456)
    df = payments({"transaction_datetime": at, "failure_reason": "Network Error"})
    write_csv(df, str(tmp_path / "out"))
    assert read_payments_csv(spark, str(tmp_path / "out")).collect() == df.collect()


def test_replacing_a_table_drops_old_rows(spark, clean, tmp_path):
    replace_table(clean({}, {}), "replace_me", str(tmp_path / "one"))
    table = replace_table(clean({}), "replace_me", str(tmp_path / "two"))
    assert table.count() == 1


def test_a_failed_write_leaves_the_old_table(spark, clean, tmp_path):
    replace_table(clean({}, {}), "stays", str(tmp_path / "t"))
    broken = clean({}).withColumn("hour", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, "stays", str(tmp_path / "t"))
    assert spark.table("stays").count() == 2


def test_replacing_removes_the_old_version(spark, clean, tmp_path):
    for rows in (1, 2, 3):
        replace_table(clean(*[{}] * rows), "versions", str(tmp_path / "t"))
    assert spark.table("versions").count() == 3
    assert len(glob.glob(f"{tmp_path}/t/version-*")) == 1


def test_replacing_is_one_change_in_the_catalogue(spark, clean, tmp_path, monkeypatch):
    """A reader in a loop always finds a whole version; the one it began with is kept."""
    replace_table(clean({}), "pointed", str(tmp_path / "t"), keep=1)
    begun = spark.table("pointed")
    seen, done = [], threading.Event()

    def read():
        while not done.is_set():
            seen.append(spark.table("pointed").count())

    reader = threading.Thread(target=read)
    reader.start()
    statements, sql = [], type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda *a, **k: statements.append(a[1]) or sql(*a, **k))
    try:
        replace_table(clean(*[{}] * 2), "pointed", str(tmp_path / "t"), keep=1)
        assert begun.count() == 1
    finally:
        done.set()
        reader.join()
    assert not any(s.startswith("DROP") for s in statements)
    assert spark.table("pointed").count() == 2
    assert seen and set(seen) <= {1, 2} and seen == sorted(seen)
    replace_table(clean(*[{}] * 3), "pointed", str(tmp_path / "t"), keep=1)
    assert len(glob.glob(f"{tmp_path}/t/version-*")) == 2
    # Other columns: dropped and created.
    assert replace_table(clean({}).select("hour"), "pointed", str(tmp_path / "t")).columns == ["hour"]
    assert len(glob.glob(f"{tmp_path}/t/version-*")) == 1


def test_row_counts_follow_the_catalogue(spark, clean, tmp_path):
    replace_table(clean({}, {}), "listed_table", str(tmp_path / "t"))
    assert "listed_table" in list_tables(spark)
    counts = dict(table_row_counts(spark, [t for t in list_tables(spark) if t == "listed_table"]).collect())
    assert counts == {"listed_table": 2}


def test_partitioned_table_is_pruned(spark, clean, tmp_path):
    months = [{"transaction_datetime": dt.datetime(2024, m, 1)} for m in (1, 2, 3)]
    table = replace_table(clean(*months), "by_month", str(tmp_path / "t"), ["year", "month"])
    plan = table.filter("month = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert table.filter("month = 2").count() == 1


def test_whole_batch(spark, sf_dir, tmp_path):
    reports = str(tmp_path / "reports")
    answers = batch.run_batch(spark, raw(spark, sf_dir), reports, str(tmp_path / "tables"))
    assert len(answers) == 17
    assert spark.table(TRANSACTIONS).count() == spark.table(SCORED).count() == 997
    for name in MART_NAMES:
        assert glob.glob(f"{reports}/{name}/part-*.csv")
    daily = glob.glob(f"{reports}/sql_outputs/executive_payment_kpis/part-*.csv")
    lines = [line for f in daily for line in open(f).read().splitlines()]
    assert lines[0].startswith("total_transactions,total_payment_volume")
    assert lines[1].startswith("997,")


def test_questions_as_sql_text(spark, sf_dir, tmp_path):
    batch.load_transactions(spark, raw(spark, sf_dir), str(tmp_path / "tables"))
    text = (
        "SELECT channel, COUNT(*) AS n, ROUND(100.0 * SUM(is_fraud) / COUNT(*), 2) AS pct "
        f"FROM {TRANSACTIONS} GROUP BY channel ORDER BY pct DESC"
    )
    answer = batch.run_questions(spark, questions={"by_channel": text})["by_channel"]
    assert answer.agg({"n": "sum"}).first()[0] == 997


def test_materialised_frame_has_no_upstream_plan(spark, clean):
    path = shared_folder(spark, "test")
    df = materialise(clean({}, {}), path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 2
    assert shared_root(spark) in plan.replace("file:", "")
    assert "LocalTableScan" not in plan and "ExistingRDD" not in plan
    remove_folder(spark, path)
    assert not os.path.exists(path)


def test_wide_ids_are_not_cut(spark):
    df = spark.createDataFrame([(7,), (123456789012,)], "n BIGINT")
    ids = [r[0] for r in df.selectExpr(padded_id("TXN", "n", 8)).collect()]
    assert ids == ["TXN00000007", "TXN123456789012"]


@pytest.fixture
def arriving(payments, tmp_path):
    folder = str(tmp_path / "arriving")

    def add(*rows):
        payments(*rows).write.mode("append").parquet(folder)
        return folder

    return add


def test_stream_scores_like_the_batch_and_resumes(spark, arriving, tmp_path):
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    twice = {"transaction_id": "A", "channel": "Online"}
    folder = arriving(twice, twice, {"transaction_id": "B", "transaction_amount": 0.0})
    for _ in range(2):
        write_stream(read_payment_stream(spark, folder), out, state).awaitTermination()
    rows = spark.read.parquet(out).select("transaction_id", "risk_score").collect()
    assert [tuple(r) for r in rows] == [("A", 8)]
    arriving(twice, {"transaction_id": "C", "is_fraud": 1})
    write_stream(read_payment_stream(spark, folder), out, state).awaitTermination()
    rows = spark.read.parquet(out).select("transaction_id", "risk_score").collect()
    assert sorted(tuple(r) for r in rows) == [("A", 8), ("C", 40)]


def test_model_predicts_on_a_stream(spark, arriving, tmp_path):
    from riskledger.models.training import predict, train
    from riskledger.operators.cleaning import repair_and_derive
    from riskledger.registry import txn

    payments = txn(spark, "/root/testdata/sf0.001")
    model = train(payments, only=["Logistic Regression"]).best
    folder = arriving({"transaction_id": "A"}, {"transaction_id": "B", "channel": "Online"})
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    write_stream(
        read_payment_stream(spark, folder),
        out,
        state,
        shape=lambda raw: predict(model, repair_and_derive(raw)),
    ).awaitTermination()
    rows = spark.read.parquet(out).orderBy("transaction_id").collect()
    assert [r.risk_score for r in rows] == [0, 8]
    assert all(0 <= r.fraud_probability <= 1 for r in rows)


@pytest.mark.parametrize("files_per_batch", [1, 1000])
def test_late_payments_are_not_lost(spark, arriving, tmp_path, files_per_batch):
    for day in (10, 1, 20, 2):
        at = dt.datetime(2024, 3, day, 12)
        row = {"transaction_id": f"D{day}", "transaction_datetime": at}
        folder = arriving(row, row)
    arriving({"transaction_id": "D1", "transaction_datetime": dt.datetime(2024, 3, 1, 12)})
    arriving({"transaction_id": "none", "transaction_datetime": None})
    out = str(tmp_path / "out")
    stream = read_payment_stream(spark, folder, files_per_batch)
    write_stream(stream, out, str(tmp_path / "state")).awaitTermination()
    ids = [r.transaction_id for r in spark.read.parquet(out).collect()]
    assert sorted(ids) == ["D1", "D10", "D2", "D20", "none"]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark, "x").startswith(named)


def test_no_folder_is_left_behind(tmp_path, sf_dir):
    """A process that reads lazily returned results and ends leaves its shared folder empty."""
    code = f"""
from riskledger.registry import QUERIES
from riskledger.session import build_session

spark = build_session("x", "local[2]", 2, **{{
    "spark.checkpoint.dir": "{tmp_path}/shared", "spark.sql.warehouse.dir": "{tmp_path}/wh"}})
for name in ("csv_sink", "cached_slices", "standardised_numerics", "damaged_csv_counters"):
    assert QUERIES[name](spark, "{sf_dir}").count()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=300)
    left = [f for _, _, files in os.walk(tmp_path / "shared") for f in files]
    assert not left
