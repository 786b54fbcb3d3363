"""Spark against the DuckDB SQL of the same name, on the smallest tables."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from helpers import SF_SMALL
from shiplog.session import TABLES


def _canon(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_canon(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    drows = sorted((tuple(_canon(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert srows == drows
