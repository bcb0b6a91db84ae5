"""The driver contract: every registered query runs; SQL-checked ones equal their DuckDB oracle."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract
from locations import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
NAMES = sorted(contract.queries())


def norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry(spark):
    df = contract.entry(spark)
    rows = df.collect()
    assert len(rows) > 0 and df.columns == ["test_id", "label", "prediction"]


def test_oracles_cover_known_queries():
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_against_oracle(spark, duck, name):
    df = contract.queries()[name](spark, SF_SMALL)
    got = [r.asDict() for r in df.collect()]
    sql = contract.oracle_sql().get(name)
    if sql is None:
        assert df.columns  # rows-only operators are covered by property tests
        return
    res = duck.sql(sql)
    cols = sorted(df.columns)
    assert sorted(res.columns) == cols
    expect = [dict(zip(res.columns, r)) for r in res.fetchall()]
    key = lambda r: repr(tuple(norm(r[c]) for c in cols))
    assert sorted(map(key, got)) == sorted(map(key, expect))
