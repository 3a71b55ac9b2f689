"""The registered queries against an independent engine, on the smallest test data."""

import os

import pytest

import __spark_entry__ as contract

SF_DIR = contract.SMOKE_DIR
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()
# Queries of documents have tests of their own.
QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.DOCUMENTS}
SQL = {k: v for k, v in contract.oracle_sql().items() if k not in contract.DOCUMENTS}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data is not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.count() == 35 and df.columns == ["section", "check_name", "subject", "value", "status", "severity"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    cols = sorted(df.columns)
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == cols
    want = sorted((tuple(row[names.index(c)] for c in cols) for row in result.fetchall()), key=repr)
    assert got == want
