"""Every registered query against its DuckDB oracle on the smallest test scale."""

import datetime as dt
import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from pricelake.plans.catalog import QUERIES
from pricelake.plans.oracle import ORACLE_SQL

TABLES = ("region", "nation", "supplier", "part", "orders", "customer", "lineitem")


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES) <= set(E.queries())
    assert set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, key):
    df = QUERIES[key](spark, SF_SMALL)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLE_SQL[key])
    d_cols, d_rows = _canon([d[0] for d in cur.description], cur.fetchall())
    assert s_cols == d_cols
    assert len(s_rows) == len(d_rows)
    assert s_rows == d_rows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [
        "state",
        "commodity",
        "record_count",
        "avg_state_price",
        "avg_national_price",
        "avg_deviation_pct",
        "max_deviation_pct",
    ]
    assert df.count() > 0
