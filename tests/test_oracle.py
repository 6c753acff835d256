"""Every registered query against its DuckDB statement on the same Parquet files."""

import glob
import math
import os

import pytest

from riskledger.oracle import SQL
from riskledger.registry import QUERIES

duckdb = pytest.importorskip("duckdb")

SCALE = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
SAME_TYPE = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SCALE}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def comparable(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return ""
    return repr(value) if isinstance(value, float) else str(value)


def in_any_order(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(comparable(row[i]) for i in order) for row in rows)


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_result(spark, con, name):
    relation = con.sql(SQL[name])
    expected_types = {c: SAME_TYPE[str(t)] for c, t in zip(relation.columns, relation.types)}
    df = QUERIES[name](spark, SCALE)
    assert {f.name: f.dataType.simpleString() for f in df.schema} == expected_types
    expected = in_any_order(relation.columns, relation.fetchall())
    assert in_any_order(df.columns, df.collect()) == expected
    assert expected, "an empty result would prove nothing"
