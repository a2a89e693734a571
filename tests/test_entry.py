"""Driver contract: entry() runs, every query has an oracle, and each matches it at sf0.001."""

import datetime
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from cartwise.plans.suite import QUERIES
from conftest import SF_SMALL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in idx) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["product_id", "abandoned_carts", "abandoned_items", "unrealized_revenue"]
    assert 0 < df.count() <= 50


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(cols)
    assert got == _canon(cols, res.fetchall())
