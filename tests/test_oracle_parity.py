"""Every catalog query against its DuckDB oracle on the driver tables."""

import datetime as dt
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_mod
from conftest import SF_SMALL
from tillwise.plans.catalog import QUERIES

TABLES = "region nation customer supplier part orders lineitem".split()
SF = os.environ.get("TILLWISE_TEST_SF", SF_SMALL)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return None if v is None else str(v)


def _sorted(records, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in records),
                  key=lambda t: tuple("" if x is None else x for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(entry_mod.queries()) and set(QUERIES) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert set(df.columns) == {"category_id", "total_revenue", "revenue_share"}
    assert df.count() > 0


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    sdf = entry_mod.queries()[key](spark, SF)
    cols = sorted(sdf.columns)
    srows = [r.asDict() for r in sdf.collect()]
    res = duck.execute(entry_mod.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    drows = [dict(zip(dcols, r)) for r in res.fetchall()]
    assert len(srows) == len(drows)
    assert _sorted(srows, cols) == _sorted(drows, cols)
