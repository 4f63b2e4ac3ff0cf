"""Registered queries against their DuckDB oracle on the smallest test data."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

KEYS = ["x2_hourly_demand", "x3_daily_funnel_metrics", "x4_pricing_analysis", "e4_pricing_cycle",
        "g12_inventory_state", "g9_demand_forecast", "r4_rfm_scores", "k5_gap_describe", "k5_gap_box",
        "u3_funnel", "b5_stock_by_warehouse", "q1_quality_report", "t5_stream_guarded_stock",
        "t8_stream_throughput"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "as_tuple"):
        return round(float(v), 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        if f.endswith(".parquet"):
            c.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{SF_SMALL}/{f}')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() == 200 and "recommendation" in df.columns


def test_every_query_has_a_callable_and_most_have_oracles():
    qs, os_ = E.queries(), E.oracle_sql()
    assert set(os_) <= set(qs)
    assert len(os_) >= 0.9 * len(qs)
