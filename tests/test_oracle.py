"""Every catalog key against its DuckDB oracle at sf0.001 (the driver checks sf0.01)."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as E
from landfall.plans.catalog import QUERIES
from oracle.duckdb_sql import DROPPED
from tests.conftest import SF001

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v)
    return v


def canon(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF001, t + '.parquet')}')")
    return c


def test_every_query_has_an_oracle_or_is_rows_only():
    q, o = E.queries(), E.oracle_sql()
    assert set(QUERIES) <= set(o) <= set(q)


def test_dropped_columns_follow_from_the_nulls(con):
    rows = con.execute(E.oracle_sql()["null_ratio"])
    at = {d[0]: i for i, d in enumerate(rows.description)}
    assert {r[at["column_name"]] for r in rows.fetchall() if r[at["dropped"]]} == set(DROPPED)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = df.columns
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert canon(got, cols) == canon(want, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["visatype", "totalcount"]
    assert df.count() == 5
