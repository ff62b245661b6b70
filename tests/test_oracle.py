"""Registered queries against their DuckDB oracle on the smallest driver tables."""

import datetime
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.date()
    return v


def key(t):
    return tuple((x is None, str(x)) for x in t)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=key)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in res.fetchall()), key=key)
    assert got == want


def test_entry_runs(spark):
    assert E.entry(spark).count() == 20
