"""The registered queries: which there are, and those with SQL against it."""

import duckdb
import pytest

import __spark_entry__ as registered
from pagequill.llm.queries import ORACLE

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    names = set(registered.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert set(ORACLE) <= set(registered.oracle_sql())


@pytest.mark.parametrize("name", list(ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings", "benchmark"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = registered.queries()[name](spark, SF)
    want = duck.execute(ORACLE[name]).fetchall()
    columns = [d[0] for d in duck.description]
    assert sorted(df.columns) == sorted(columns)
    got = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
