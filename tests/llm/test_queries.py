"""Registered queries against their SQL, and the pipeline against its parts."""

import glob
import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brute import alnum_words, contamination, near_duplicates
from riskledger.llm.queries import QUERIES, SQL

duckdb = pytest.importorskip("duckdb")

SCALE = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SCALE}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_one_query_per_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, con, name):
    relation = con.sql(SQL[name])
    df = QUERIES[name](spark, SCALE)
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    place = [relation.columns.index(c) for c in columns]
    expected = sorted(str(tuple(r[i] for i in place)) for r in relation.fetchall())
    assert sorted(str(tuple(r[c] for c in columns)) for r in df.collect()) == expected


@pytest.fixture(scope="module")
def stored(spark):
    """What each stage of the pipeline returns, in order."""
    from riskledger.llm.storage import Scratch

    scratch = Scratch(spark, "stages")
    docs = spark.read.parquet(f"{SCALE}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(scratch.write(name, stage(spark, out[-1], SCALE)))
    return out


def test_stages(spark, stored):
    docs, identified, lines, unique, clean, encoded = stored
    for stage in (identified, lines, unique, clean):
        assert stage.columns == docs.columns
    letters = docs.filter(F.col("text").rlike(r"\p{L}"))
    assert identified.exceptAll(letters).isEmpty() and letters.exceptAll(identified).isEmpty()
    assert lines.count() == identified.count()
    rows = [(r.doc_id, r.text) for r in lines.collect()]
    kept = {i for i, (n, component) in near_duplicates(rows).items() if n == 0 or component == i}
    assert {r.doc_id for r in unique.collect()} == kept
    rows = [(r.doc_id, r.text) for r in unique.collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SCALE}/benchmark.parquet").collect()]
    hit = contamination(rows, items)
    assert {r.doc_id for r in clean.collect()} == {i for (i, _), h in zip(rows, hit) if not h[-1]}
    assert encoded.count() == clean.count() and encoded.filter("NOT round_trip").isEmpty()


def test_run_returns_the_last_stage(spark, stored):
    run = corpus_pipeline.run(spark, SCALE)
    assert run.exceptAll(stored[-1]).isEmpty() and run.count() == stored[-1].count()


def test_words_of_the_brute_force():
    assert alnum_words("Ab-c É9") == ["ab", "c", "É9"]


def test_pipeline_on_odd_rows(spark, documents, tmp_path):
    rows = [(1, "they would have been there and which", "en", "a"), (2, None, None, None), (3, "", "en", "a"),
            (4, "nicht durch die werden und sich", "de", "b"), (4, "nicht durch die werden und sich", "de", "b"),
            (None, "the and which of them", "en", None), (5, "word " * 30_000, "en", "a")]
    documents(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SCALE}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "4", "4", "5", "None"]
    documents([]).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
