"""Driver contract: entry smoke check, and every query against its SQL oracle (sf0.001)."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tidewater.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert [f.name for f in df.schema.fields] == ["team", "conference", "conf_rank", "wins", "losses",
                                                   "w_l_pct", "gb"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 90


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    rel = duck.sql(entry.oracle_sql()[name])
    want = [tuple(r) for r in rel.fetchall()]
    assert [f.name for f in df.schema.fields] == list(rel.columns)
    assert Counter(tuple(_norm(x) for x in r) for r in got) == Counter(tuple(_norm(x) for x in r) for r in want)
