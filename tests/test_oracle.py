"""Every registered query against its DuckDB oracle on sf0.001 (the driver
runs the same comparison at sf0.01)."""

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb
import pytest

from webledger.plans.registry import all_oracles, all_queries
from webledger.sources.tables import TABLES

ORACLES = all_oracles()
QUERIES = all_queries()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool) or isinstance(v, int):
        return v
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        return None if math.isnan(f) else round(f, 6) + 0.0
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], Counter(tuple(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_is_registered_with_entry_contract():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) >= 100


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    scols, srows = _rows(df.columns, df.collect())
    cur = duck.execute(ORACLES[name])
    ocols, orows = _rows([d[0] for d in cur.description], cur.fetchall())
    assert scols == ocols
    assert srows == orows


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, sf, name):
    assert QUERIES[name](spark, sf).count() >= 0
