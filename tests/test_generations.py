"""Tables by day as generations: what a change writes, what a reader sees, refreshed marts."""
import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.distinct import distinct_counts
from shelfcast.plans import marts
from shelfcast.session import scratch_path
from shelfcast.sources.generations import DayTable, refresh

SCHEMA = "event_id long, event_type string, product_id long, session_id string, timestamp timestamp"


def _events(spark, rows):
    """(id, type, product, session, day of January or None)"""
    rows = [(i, t, p, s, None if day is None else dt.datetime(2024, 1, day, 5, i % 60)) for i, t, p, s, day in rows]
    return spark.createDataFrame(rows, SCHEMA).withColumn("date", F.to_date("timestamp"))


@pytest.fixture
def base(spark):
    return scratch_path(spark, "generations", uuid.uuid4().hex)


def _ids(df):
    return sorted(r["event_id"] for r in df.collect())


def _versions(table):
    return {d: e["versions"] for d, e in table.manifest()["days"].items()}


def test_append_adds_and_compaction_keeps_the_rows(spark, base):
    t = DayTable(spark, base)
    assert t.read() is None and t.compact() == []
    assert sorted(t.append(_events(spark, [(1, "purchase", 1, "a", 1), (2, "purchase", 1, "a", 2), (9, "x", None, None, None)]))) \
        == ["2024-01-01", "2024-01-02", "__HIVE_DEFAULT_PARTITION__"]
    assert t.append(_events(spark, [(3, "purchase", 1, "a", 2)])) == ["2024-01-02"]
    assert _ids(t.read()) == [1, 2, 3, 9] and _ids(t.read(["2024-01-02", "2030-01-01"])) == [2, 3]
    assert [r["date"] for r in t.read(["__HIVE_DEFAULT_PARTITION__"]).collect()] == [None]
    before = t.manifest()
    assert t.compact() == ["2024-01-02"] and t.compact() == []
    now = t.manifest()
    assert [len(v) for v in _versions(t).values()] == [1, 1, 1]
    assert now["days"]["2024-01-01"] == before["days"]["2024-01-01"]
    assert now["days"]["2024-01-02"]["changed"] == before["days"]["2024-01-02"]["changed"]
    assert _ids(t.read()) == [1, 2, 3, 9] and t.read().schema.names == _events(spark, []).schema.names


def test_a_reader_keeps_its_generation_while_the_table_changes(spark, base):
    t = DayTable(spark, base, keep=2)
    t.append(_events(spark, [(1, "x", 1, "a", 1)]))
    t.append(_events(spark, [(2, "x", 1, "a", 1)]))
    held = t.manifest()
    reader = t.read(manifest=held)
    t.compact()
    assert _ids(reader) == [1, 2]                       # its files still lie there
    t.append(_events(spark, [(3, "x", 1, "a", 2)]))     # the generation before the compaction goes
    assert len(t.generations()) == 2
    left = {os.path.basename(p) for p, dirs, files in os.walk(base + "/data") for f in files if f.endswith(".parquet")
            for p in [os.path.dirname(p)]}
    assert left == {"v=3-compact", "v=4-append"} and _ids(t.read()) == [1, 2, 3]


def test_an_append_during_a_compaction_is_not_lost(spark, base):
    t, other = DayTable(spark, base, keep=9), DayTable(spark, base, keep=9)
    for i in (1, 2):
        t.append(_events(spark, [(i, "x", 1, "a", 1)]))
    publish = t._publish

    def late(schema, change):
        other.append(_events(spark, [(3, "x", 1, "a", 1), (4, "x", 1, "a", 2)]))
        publish(schema, change)
    t._publish = late
    assert t.compact() == ["2024-01-01"]
    assert _ids(t.read()) == [1, 2, 3, 4] and [len(v) for v in _versions(t).values()] == [2, 1]
    t._publish = lambda schema, change: (other.replace(_events(spark, [(7, "x", 1, "a", 1)]), ["2024-01-01"]), publish(schema, change))
    t.compact()
    assert _ids(t.read()) == [4, 7]                     # what was replaced meanwhile does not come back


def test_an_unpublished_write_is_invisible_and_replaced(spark, base):
    t = DayTable(spark, base)
    t.append(_events(spark, [(1, "x", 1, "a", 1)]))
    t._write(_events(spark, [(2, "x", 1, "a", 1), (3, "x", 1, "a", 3)]), "append")   # the loader is lost here
    assert _ids(t.read()) == [1] and list(t.manifest()["days"]) == ["2024-01-01"]
    t.append(_events(spark, [(2, "x", 1, "a", 1)]))
    assert _ids(t.read()) == [1, 2]
    assert sorted(os.listdir(base + "/data")) == ["v=1-append", "v=2-append"]


def test_replace_drops_emptied_days_and_refuses_others(spark, base):
    t = DayTable(spark, base)
    t.replace(_events(spark, [(1, "x", 1, "a", 1), (2, "x", 1, "a", 2)]))
    t.replace(_events(spark, [(5, "x", 1, "a", 2)]), ["2024-01-01", "2024-01-02"])
    assert _ids(t.read()) == [5] and list(t.manifest()["days"]) == ["2024-01-02"]
    with pytest.raises(ValueError):
        t.replace(_events(spark, [(6, "x", 1, "a", 3)]), ["2024-01-02"])
    assert _ids(t.read()) == [5]
    t.replace(_events(spark, []))
    assert _ids(t.read()) == [] and t.manifest()["days"] == {}


def _rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def test_refresh_builds_changed_days_and_equals_the_full_build(spark, base):
    products = spark.createDataFrame([(1, "a"), (2, "b")], "product_id long, category string")
    log = DayTable(spark, base + "/log")
    hourly, funnel = DayTable(spark, base + "/hourly"), DayTable(spark, base + "/funnel", "day")

    def run(dim):
        def hours(ev):
            return marts.hourly_demand(ev, dim).withColumn("date", F.to_date("hour_bucket"))
        got = refresh(log, hourly, hours, dim), refresh(log, funnel, lambda ev: marts.daily_funnel_metrics(ev, dim), dim)
        if log.read() is not None:
            assert _rows(hourly.read()) == _rows(hours(log.read()))
            assert _rows(funnel.read()) == _rows(marts.daily_funnel_metrics(log.read(), dim))
        return [sorted(g) for g in got]
    days = ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert run(products) == [[], []] and hourly.read() is None   # nothing has come yet
    first = _events(spark, [(1, "product_view", 1, "s", 1), (2, "purchase", 2, "s", 2), (3, "page_view", None, "t", 3)])
    log.append(first)
    assert run(products) == [days, days]
    kept = _versions(funnel)
    log.append(_events(spark, [(4, "purchase", 1, "s", 1), (5, "purchase", 1, None, 1)]))     # late rows of an old day
    assert run(products) == [days[:1], days[:1]]
    assert {d: v for d, v in _versions(funnel).items() if d != days[0]} == {d: v for d, v in kept.items() if d != days[0]}
    log.append(_events(spark, [(6, "purchase", 1, "u", None)]))                               # no time at all
    assert run(products) == [["__HIVE_DEFAULT_PARTITION__"]] * 2
    log.compact()
    assert run(products) == [[], []]
    assert [len(g) for g in run(products.withColumn("category", F.upper("category")))] == [4, 4]
    assert run(products.withColumn("category", F.upper("category")))[0] == []


def test_distinct_counts_equal_count_distinct_without_expand(spark):
    df = spark.createDataFrame([(1, "a", 2), (1, None, 2), (None, "a", None), (2, "b", 2), (None, None, None)],
                               "x long, y string, z long")
    for data in (df, df.limit(0), df.where("x IS NULL")):
        got = distinct_counts(data, {"nx": "x", "ny": "y", "nxy": ["x", "y"]}, F.count("*").alias("n"), F.max("z").alias("m"))
        want = data.agg(F.count_distinct("x"), F.count_distinct("y"), F.count_distinct("x", "y"), F.count("*"), F.max("z")).first()
        r = got.first()
        assert (r["nx"], r["ny"], r["nxy"], r["n"], r["m"]) == tuple(want)
    assert "Expand" not in got._jdf.queryExecution().toString()
    assert list(distinct_counts(df, {"nx": "x"}).first()) == [2]


@pytest.mark.parametrize("key", ["a3_count_distinct", "u1_clickstream_overview", "r1_purchase_overview", "g1_demand_overview",
                                 "k1_price_overview"])
def test_overviews_have_no_expand(spark, key):
    import __spark_entry__ as E
    plan = E.queries()[key](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Expand" not in plan
