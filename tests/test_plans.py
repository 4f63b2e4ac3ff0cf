"""Plan assertions: the batch plans stay JVM-side and push work into the scan."""
from conftest import SF_SMALL

import __spark_entry__ as E


def _plan(spark, key):
    return E.queries()[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_batch_marts(spark):
    for key in ["x2_hourly_demand", "x3_daily_funnel_metrics", "e4_pricing_cycle", "r4_rfm_scores",
                "g9_demand_forecast"]:
        p = _plan(spark, key)
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_filters_and_columns_pushed_to_scan(spark):
    p = _plan(spark, "x2_hourly_demand")
    assert "PushedFilters" in p and "ReadSchema" in p
    assert "l_comment" not in p


def test_catalogue_joins_come_after_the_reduction(spark):
    """Events and observations are read at most twice and aggregated below every join."""
    for key, table, reads in (("x3_daily_funnel_metrics", "events.parquet", 2), ("u6_funnel_by_category", "events.parquet", 1)):
        p = _plan(spark, key)
        scans = [x for x in p.split("FileScan parquet")[1:] if table in x]
        assert 0 < len(scans) <= reads, (key, len(scans))
        lowest = p[:p.rindex("Join")].count("HashAggregate") < p.count("HashAggregate")
        assert lowest, key


def test_funnel_keeps_groups_without_sessions(spark):
    from pyspark.sql import functions as F
    from shelfcast.plans.funnel import funnel_by_category
    from shelfcast.plans.marts import daily_funnel_metrics
    products = spark.createDataFrame([(1, "a")], "product_id long, category string")
    ev = spark.createDataFrame([(None, 1, "product_view"), ("s", None, "page_view"), ("s", 9, "purchase"), ("s", 1, "purchase")],
                               "session_id string, product_id long, event_type string").withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    got = {r["category"]: (r["page_views"], r["product_views"], r["purchases"], r["conversion_rate"])
           for r in daily_funnel_metrics(ev, products).collect()}
    assert got == {"a": (0, 0, 1, None), "unknown": (1, 0, 1, 100.0)}
    none = ev.filter("session_id IS NULL")
    assert [r["product_views"] for r in daily_funnel_metrics(none, products).collect()] == [0]
    assert [(r["product_view"], r["purchase"]) for r in funnel_by_category(ev, products).collect()] == [(0, 1)]


def test_funnel_has_no_expand(spark):
    assert "Expand" not in _plan(spark, "x3_daily_funnel_metrics")
