"""Every registered query against its SQL in DuckDB, and the shape of its plan."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from ledgermill.verification.oracle import oracle_texts
from ledgermill.verification.queries import REGISTRY

NO_SQL = {"loan_default_scores", "interventions"}
QUERIES = dict(REGISTRY)
ORACLE = oracle_texts()


@pytest.fixture(scope="module")
def duck(small_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{small_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(record[i]) for i in order) for record in records)


def test_every_query_has_sql_or_a_reason():
    assert set(QUERIES) - set(ORACLE) == NO_SQL
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, small_dir, name):
    df = QUERIES[name](spark, small_dir)
    got = df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name in NO_SQL:
        assert got
        return
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, got) == rows(columns, cursor.fetchall())


def test_entry(spark, small_dir):
    df = entry_points.entry(spark)
    assert df.count() > 0 and "efficiency_rating" in df.columns
