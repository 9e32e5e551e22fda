"""Driver contract: entry runs, every query has a callable, oracles match at sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF

TABLES = sorted(f.removesuffix(".parquet") for f in os.listdir(SF))


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "dpd_current" in df.columns and "vpn" in df.columns


def test_oracles_cover_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(o) >= 47


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t + '.parquet')}')")
    return con


def _norm(v):
    import datetime as dt
    import decimal

    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert len(got) == len(exp)
    assert got == exp
