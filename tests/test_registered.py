"""Every registered query against its SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered
from checks import oracle
from checks.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def comparable(columns, data):
    order = [columns.index(c) for c in sorted(columns)]
    plain = lambda v: "inf" if isinstance(v, float) and math.isinf(v) else repr(v)
    return sorted(tuple(plain(row[i]) for i in order) for row in data)


def test_keys_match():
    assert set(oracle.oracle_sql()) == set(QUERIES)
    assert set(QUERIES) <= set(registered.queries())
    assert set(registered.oracle_sql()) <= set(registered.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = registered.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in plan
    result = duck.execute(registered.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, result.fetchall())


def test_entry(spark):
    df = registered.entry(spark)
    assert df.columns == ["rank", "id"] and df.count() == 10


def test_scans_read_only_what_they_need(spark):
    """Counting words reads one column of the documents."""
    plan = registered.queries()["word_count"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<text:string>" in plan
    plan = registered.queries()["title_list"](spark, SF)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<html:string>" in plan
