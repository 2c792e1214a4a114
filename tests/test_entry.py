"""Driver contract: entry runs, every query has an oracle, oracles agree at sf0.001."""
import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from marquee.plans.catalog import QUERIES
from marquee.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["director", "revenue"]
    assert df.count() > 0


def test_every_query_has_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return float(v) if v != v.to_integral_value() else int(v)
    if isinstance(v, float):
        return round(v, 6) if not math.isnan(v) else "nan"
    return v


def _canon(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in data]
    return [names[i] for i in order], sorted(out, key=lambda t: [(x is None, str(x)) for x in t])


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    rel = duck.sql(E.oracle_sql()[name])
    want = _canon(rel.columns, rel.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
