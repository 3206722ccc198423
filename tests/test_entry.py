import os

import duckdb
import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations"]


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert {"exchange", "symbol", "open_us", "open", "close", "volume", "tick_count"} <= set(df.columns)


def test_every_query_has_an_oracle():
    from tickengine.plans.oracle import oracle_sql
    from tickengine.plans.queries import queries

    assert set(queries()) == set(oracle_sql())
    assert set(queries()) <= set(entry.queries()) and set(oracle_sql()) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def norm(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return repr(v)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    cols = df.columns
    got = sorted(tuple(norm(r[c]) for c in sorted(cols)) for r in df.collect())
    cur = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    idx = [ocols.index(c) for c in sorted(ocols)]
    want = sorted(tuple(norm(r[i]) for i in idx) for r in cur.fetchall())
    assert got == want
