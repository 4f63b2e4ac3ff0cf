"""Quality rules on seeded violations; incremental lake export semantics; funnel guards."""
import datetime as dt
import tempfile
from decimal import Decimal as D

from pyspark.sql import functions as F

from shelfcast.plans import funnel, quality
from shelfcast.sources import lake


def _tables(spark):
    products = spark.createDataFrame([(1, "a", "x", D("10.00")), (2, "b", "x", D("-1.00"))],
                                     "product_id long, product_name string, category string, base_price decimal(10,2)")
    stock = spark.createDataFrame([(1, "WH-LAGOS", -3), (1, "WH-ABUJA", 200000)],
                                  "product_id long, warehouse_id string, current_stock long")
    t0 = dt.datetime(2024, 1, 1)
    ev = spark.createDataFrame([(1, "bogus", 9, t0), (2, "purchase", 1, t0 + dt.timedelta(hours=1))],
                               "event_id long, event_type string, product_id long, timestamp timestamp")
    cp = spark.createDataFrame([(1, "Nobody", D("0.00"), D("90.00"))],
                               "product_id long, competitor_name string, competitor_price decimal(10,2), "
                               "price_difference_pct decimal(6,2)")
    recs = spark.createDataFrame([(7, "maybe", 1.5, 3.0)],
                                 "product_id long, recommendation string, confidence_score double, recommended_price double")
    return {"products": products, "inventory_state": stock, "clickstream_events": ev, "competitor_prices": cp,
            "pricing_recommendations": recs, "orphan_events": quality.orphans(ev, products),
            "orphan_recommendations": quality.orphans(recs, products),
            **dict.fromkeys(("orphan_stock", "orphan_inventory", "orphan_competitor_prices"),
                            quality.orphans(spark.createDataFrame([(1,), (99,), (None,)], "product_id long"), products))}


def test_each_reference_rule_fails_on_its_seeded_row(spark):
    tables = _tables(spark)
    ev = tables["clickstream_events"]
    rules = [r for r in quality.default_rules(lambda: F.lit(2),
                                              as_of=lambda: F.lit("2024-01-01 00:30:00").cast("timestamp"))
             if r.group != "Schema"]
    found = quality.run_rules(tables, rules).collect()
    rep = {r["rule_name"]: r["passed"] for r in found}
    assert {r["rule_name"]: r["detail"] for r in found}["foreign key inventory_state.product_id"] == "1 against exactly 0"
    assert rep.pop("table_not_empty") is True
    assert rep.pop("pricing_recommendations.recommended_price > 0") is True
    assert all(v is False for v in rep.values()), rep
    summary = {r["rule_group"]: (r["passed"], r["failed"]) for r in quality.summarize(
        quality.run_rules(tables, rules)).collect()}
    assert summary["ALL"][0] + summary["ALL"][1] == len(rules)
    assert ev.count() == 2


def test_empty_table_rule(spark):
    empty = spark.createDataFrame([], "event_id long, event_type string, product_id long, timestamp timestamp")
    r = quality.Rule("Clickstream", "table_not_empty", "t", lambda: F.count(F.lit(1)), "ge", 1)
    assert quality.run_rules({"t": empty}, [r]).first()["passed"] is False


def test_incremental_export_keeps_both_exports_and_uses_strict_cursor(spark):
    root = tempfile.mkdtemp()
    t0 = dt.datetime(2024, 1, 1, 10)
    first = spark.createDataFrame([(1, t0), (2, t0 + dt.timedelta(minutes=5))], "event_id long, timestamp timestamp")
    out = lake.export_all(spark, {"ev": (first, "timestamp")}, root + "/data", root + "/state").first()
    assert out["exported_rows"] == 2
    # same day, later run: one row equal to the cursor (not re-exported), one newer
    second = first.unionByName(spark.createDataFrame([(3, t0 + dt.timedelta(minutes=5)),
                                                      (4, t0 + dt.timedelta(minutes=9))],
                                                     "event_id long, timestamp timestamp"))
    out2 = lake.export_all(spark, {"ev": (second, "timestamp")}, root + "/data", root + "/state").first()
    assert out2["exported_rows"] == 1
    ids = sorted(r["event_id"] for r in spark.read.parquet(root + "/data/ev").collect())
    assert ids == [1, 2, 4]          # earlier files of the day are kept
    assert spark.read.parquet(root + "/data/ev").select("date").distinct().count() == 1


def test_funnel_guards_zero_page_views(spark):
    ev = spark.createDataFrame([(1, "s1", "product_view"), (2, "s1", "purchase")],
                               "event_id long, session_id string, event_type string")
    rows = {r["stage"]: r for r in funnel.funnel(ev).collect()}
    assert rows["Page View"]["sessions"] == 0
    assert rows["Purchase"]["overall_cvr_pct"] == 100.0      # denominator 0 -> 1
    assert rows["Product View"]["step_cvr_pct"] == 100.0


def test_approx_distinct_close_to_exact(spark):
    from conftest import SF_ORACLE
    from shelfcast.sources.fixtures import Domain
    ev = Domain(spark, SF_ORACLE).clickstream()
    exact = funnel.clickstream_overview(ev).first()
    approx = funnel.clickstream_overview(ev, approx=True).first()
    for c in ["unique_users", "unique_sessions"]:
        assert abs(approx[c] - exact[c]) <= 0.03 * exact[c]


def test_parts_are_counted_in_the_scan_of_their_table(spark):
    """Orphans and staged views through ``quality_tables``: one aggregation a table, NULL references are no orphans."""
    products = spark.createDataFrame([(1,), (1,), (None,)], "product_id long")
    stock = spark.createDataFrame([(1, 5), (99, 5), (None, 5), (None, 6), (98, 1)], "product_id long, current_stock long")
    builders = [lambda: products, lambda: stock] + [lambda: stock] * 11
    tables = quality.quality_tables(*builders)
    rules = [quality.Rule("g", "orphans", "orphan_stock", quality._count, "eq", 0),
             quality.Rule("g", "rows", "inventory_state", quality._count, "eq", 5),
             quality.Rule("g", "sum", "inventory_state", lambda: F.sum("current_stock"), "eq", 22)]
    report = quality.run_rules(tables, rules)
    assert [(r["rule_name"], r["value"]) for r in report.collect()] == [("orphans", 2), ("rows", 5), ("sum", 22)]
    assert quality.run_rules(tables, rules[:2]).count() == 2
    try:
        quality.run_rules(tables, [quality.Rule("g", "bad", "orphan_stock", lambda: F.max("current_stock"), "eq", 0)])
        raise AssertionError("a metric of a part must be a count")
    except ValueError:
        pass


def test_a_summary_evaluates_the_report_once(spark):
    rows = spark.sparkContext.accumulator(0)

    def counted(batches):
        for pdf in batches:
            rows.add(len(pdf))
            yield pdf
    report = spark.createDataFrame([("a", True), ("a", False), ("b", True)], "rule_group string, passed boolean").mapInPandas(
        counted, "rule_group string, passed boolean")
    got = {r["rule_group"]: (r["rules"], r["passed"], r["failed"]) for r in quality.summarize(report).collect()}
    assert got == {"a": (2, 1, 1), "b": (1, 1, 0), "ALL": (3, 2, 1)} and rows.value == 3


def test_a_report_takes_the_latest_prices_from_one_written_table(spark):
    from conftest import SF_SMALL
    from shelfcast import queries_quality
    from shelfcast.sources.fixtures import Domain
    tables = queries_quality._tables(Domain(spark, SF_SMALL))
    found = tables["stg_competitor_prices"]()
    assert {f.split("/")[-2].rsplit("-", 1)[0] for f in found.inputFiles()} == {"quality-latest"}
    assert found.count() > 0
