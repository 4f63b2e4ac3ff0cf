"""Stream = batch checks with duplicates, bad messages and restarts."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from shelfcast.sources.streams import json_lines_stream, parse_events
from shelfcast.streaming import jobs

SCHEMA = "event_id long, event_type string, product_id long, product_price double, timestamp string"


def _write(d, name, lines):
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def test_parse_and_dedup_across_batches(spark):
    land = tempfile.mkdtemp()
    out = tempfile.mkdtemp()
    ev = lambda i, t, ts: json.dumps({"event_id": i, "event_type": t, "product_id": 1, "product_price": 2.5,
                                      "timestamp": ts, "unknown": "x"})
    _write(land, "a.json", [ev(1, "purchase", "2024-01-01T00:00:00Z"), ev(1, "purchase", "2024-01-01T00:00:00Z"),
                            "{not json", ev(2, "product_view", "2024-01-01T00:01:00Z")])
    _write(land, "b.json", [ev(2, "product_view", "2024-01-01T00:01:00Z"), json.dumps({"event_id": 3}),
                            ev(4, "add_to_cart", "2024-01-01T00:02:00Z")])
    raw = json_lines_stream(spark, land, max_files_per_trigger=1)
    good, bad = parse_events(raw, spark.createDataFrame([], SCHEMA).schema)
    good = good.withColumn("timestamp", F.to_timestamp("timestamp"))
    d = jobs.dedup(good.filter(F.col("timestamp").isNotNull()))
    q = jobs.start(d, out + "/ck", trigger={"availableNow": True}, fmt="parquet", path=out + "/o")
    q.awaitTermination()
    ids = sorted(r["event_id"] for r in spark.read.parquet(out + "/o").collect())
    assert ids == [1, 2, 4]
    # restart from the checkpoint: nothing is reprocessed
    q = jobs.start(d, out + "/ck", trigger={"availableNow": True}, fmt="parquet", path=out + "/o")
    q.awaitTermination()
    assert spark.read.parquet(out + "/o").count() == 3
    qb = jobs.start(bad, out + "/ckb", trigger={"availableNow": True}, fmt="parquet", path=out + "/bad")
    qb.awaitTermination()
    assert [r["raw_message"] for r in spark.read.parquet(out + "/bad").collect()] == ["{not json"]


def test_upsert_snapshot_is_idempotent(spark):
    base = tempfile.mkdtemp()
    snap = jobs.Snapshot(spark, base + "/s")
    sink = jobs.upsert_sink(snap, ["k"], ["ts"])
    b0 = spark.createDataFrame([(1, 10, "a"), (2, 10, "b")], "k long, ts long, v string")
    b1 = spark.createDataFrame([(1, 5, "late"), (2, 11, "c")], "k long, ts long, v string")
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replay of the same batch
    got = {r["k"]: r["v"] for r in snap.read().collect()}
    assert got == {1: "a", 2: "c"}


def _files(path):
    return {os.path.join(r, f) for r, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_a_batch_rewrites_only_its_buckets_and_old_versions_go(spark):
    path = tempfile.mkdtemp() + "/s"
    snap = jobs.Snapshot(spark, path, buckets=16)
    sink = jobs.additive_sink(snap, ["k"], ["n"])
    sink(spark.range(500).selectExpr("id AS k", "1L AS n"), 0)
    first = _files(path)
    assert len({os.path.basename(os.path.dirname(f)) for f in first}) == 16
    sink(spark.createDataFrame([(7, 5)], "k long, n long"), 1)
    second = _files(path) - first
    assert len({os.path.dirname(f) for f in second}) == 1 and first <= _files(path)
    sizes = []
    for i in range(2, 12):
        sink(spark.createDataFrame([(7, 5)], "k long, n long"), i)
        sizes.append(len(_files(path)))
    assert len(set(sizes)) == 1  # disk use stays flat
    got = {r["k"]: r["n"] for r in snap.read().collect()}
    assert got == {k: 1 + 55 * (k == 7) for k in range(500)}
    before = {r["k"]: r["n"] for r in snap.read(before=11).collect()}
    assert before[7] == 51


def test_a_batch_that_failed_leaves_nothing_visible(spark):
    path = tempfile.mkdtemp() + "/s"
    snap = jobs.Snapshot(spark, path)
    assert snap.read() is None
    rows = spark.createDataFrame([(1, 1), (None, 2)], "k long, n long")
    jobs.additive_sink(snap, ["k"], ["n"])(rows, 0)
    with pytest.raises(ZeroDivisionError):
        snap.merge(rows, 1, ["k"], lambda kept, new: 1 / 0)
    os.makedirs(path + "/data/v=1/_bucket=3")  # what a lost driver may have left
    assert sorted(map(tuple, snap.read().collect()), key=str) == [(1, 1), (None, 2)]
    jobs.additive_sink(snap, ["k"], ["n"])(rows, 1)
    assert sorted(map(tuple, snap.read().collect()), key=str) == [(1, 2), (None, 4)]


def test_latest_price_ignores_late_older_observation(spark):
    land, out = tempfile.mkdtemp(), tempfile.mkdtemp()
    cols = "product_id long, competitor_name string, competitor_price decimal(10,2), our_price decimal(10,2), " \
           "price_difference decimal(10,2), price_difference_pct decimal(6,2), timestamp timestamp, " \
           "src_order long, src_line int"
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    rows1 = [(1, "TechMart", 10, 12, -2, -16.67, t + dt.timedelta(hours=2), 1, 1)]
    rows2 = [(1, "TechMart", 9, 12, -3, -25.0, t + dt.timedelta(hours=1), 2, 1),   # late, older
             (2, "TechMart", 5, 6, -1, -16.67, t, 3, 1)]
    from decimal import Decimal as D
    conv = lambda rs: [(a, b, D(c), D(e), D(f), D(str(g)), h, i, j) for a, b, c, e, f, g, h, i, j in rs]
    spark.createDataFrame(conv(rows1), cols).write.parquet(land + "/f1")
    spark.createDataFrame(conv(rows2), cols).write.parquet(land + "/f2")
    schema = spark.read.parquet(land + "/f1").schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(land + "/*")
    snap = jobs.Snapshot(spark, out + "/snap")
    up = jobs.upsert_sink(snap, ["product_id", "competitor_name"], ["timestamp", "src_order", "src_line"])
    q = jobs.start(jobs.latest_competitor_prices(s), out + "/ck", output_mode="update",
                   trigger={"availableNow": True}, sink=up)
    q.awaitTermination()
    got = {r["product_id"]: float(r["competitor_price"]) for r in snap.read().collect()}
    assert got == {1: 10.0, 2: 5.0}


def test_guarded_stock_stream_equals_batch(spark):
    from shelfcast.sources import fixtures
    from shelfcast.sources.streams import table_stream
    from shelfcast.operators.fold import guarded_fold
    from shelfcast.plans.state import INVENTORY_ORDER
    from conftest import SF_SMALL
    out = tempfile.mkdtemp()
    s = fixtures.inventory_events_from(table_stream(spark, SF_SMALL, "lineitem"))
    snap = jobs.Snapshot(spark, out + "/s")
    q = jobs.start(s, out + "/ck", sink=jobs.stock_sink(snap), trigger={"availableNow": True})
    q.awaitTermination()
    stream = {(r["product_id"], r["warehouse_id"]): r["current_stock"] for r in snap.read().collect()}
    batch_df = guarded_fold(fixtures.inventory_events(spark, SF_SMALL), ["product_id", "warehouse_id"],
                            INVENTORY_ORDER, "quantity_change")
    batch = {(r["product_id"], r["warehouse_id"]): r["current_stock"] for r in batch_df.collect()}
    assert stream == batch and len(batch) > 0


def _events(spark, *rows):
    return spark.createDataFrame(list(rows), "event_id long, event_type string, product_id long, product_price decimal(10,2), t string") \
        .select("event_id", "event_type", "product_id", "product_price", F.col("t").cast("timestamp").alias("timestamp"))


def test_event_log_survives_replays_repetitions_and_late_rows(spark):
    base = tempfile.mkdtemp()
    metrics = jobs.Snapshot(spark, base + "/m")
    sink = jobs.clickstream_fanout(spark, None, base + "/log", metrics)
    first = _events(spark, (1, "product_view", 7, None, "2024-01-02 00:00:00"), (1, "product_view", 7, None, "2024-01-02 00:00:00"),
                    (2, "purchase", 7, None, "2024-01-02 00:00:00"))
    late = _events(spark, (2, "purchase", 7, None, "2024-01-02 00:00:00"), (3, "product_view", 7, None, "2023-12-01 00:00:00"))
    for batch, n in ((first, 0), (first, 0), (late, 1), (late, 1), (late, 2)):
        sink(batch, n)
    assert sorted(r["event_id"] for r in spark.read.parquet(base + "/log").collect()) == [1, 2, 3]
    row = metrics.read().first()
    assert (row["total_views"], row["total_purchases"]) == (2, 1)


def test_stock_stream_continues_from_its_snapshot(spark):
    import datetime as dt
    base = tempfile.mkdtemp()
    snap = jobs.Snapshot(spark, base + "/s")
    sink = jobs.stock_sink(snap)

    def batch(*changes):
        return spark.createDataFrame([(k, "W", c, dt.datetime(2024, 1, 1), i, 1) for i, (k, c) in enumerate(changes)],
                                     "product_id long, warehouse_id string, quantity_change int, timestamp timestamp, src_order long, src_line int")
    sink(batch((1, 5), (2, 1)), 0)
    sink(batch((1, -4), (1, -4)), 1)
    sink(batch((1, -4), (1, -4)), 1)  # replay
    got = {r["product_id"]: (r["current_stock"], r["skipped_changes"], r["events"]) for r in snap.read().collect()}
    assert got == {1: (1, 1, 3), 2: (1, 0, 1)}


def test_stock_stream_counts_a_repeated_message_once(spark):
    import datetime as dt
    base = tempfile.mkdtemp()
    snap = jobs.Snapshot(spark, base + "/s")
    sink = jobs.stock_sink(snap, base + "/log")

    def batch(*changes):
        return spark.createDataFrame([(e, 1, "W", c, dt.datetime(2024, 1, e), e, 1) for e, c in changes],
                                     "event_id long, product_id long, warehouse_id string, quantity_change int, timestamp timestamp, src_order long, src_line int")
    for changes, n in ((((1, 5), (1, 5), (2, -2)), 0), (((2, -2), (3, -1)), 1), (((2, -2), (3, -1)), 1), (((1, 5), (3, -1)), 2)):
        sink(batch(*changes), n)
    row = snap.read().first()
    assert (row["current_stock"], row["events"], row["skipped_changes"]) == (2, 3, 0)


def test_parse_events_splits_on_the_parser(spark):
    lines = ['{"event_id": 2, bad}', '  {"event_id": 3}', '{"event_id": "x"}', '{"event_id": 4, "extra": 1}', "", "[1]"]
    good, bad = parse_events(spark.createDataFrame([(x,) for x in lines], "value string"), spark.createDataFrame([], "event_id long").schema)
    assert sorted(r["event_id"] for r in good.collect()) == [3, 4]
    assert sorted(r["raw_message"] for r in bad.collect()) == ["", "[1]", '{"event_id": "x"}', '{"event_id": 2, bad}']


def test_pricing_from_state_equals_the_cycle_over_all_events(spark):
    from conftest import SF_SMALL
    from shelfcast.plans.pricing import pricing_cycle
    from shelfcast.sources.fixtures import Domain
    base = tempfile.mkdtemp()
    d = Domain(spark, SF_SMALL)
    prices = jobs.Snapshot(spark, base + "/prices")
    jobs.upsert_sink(prices, ["product_id", "competitor_name"], ["timestamp", "src_order", "src_line"])(
        jobs.latest_competitor_prices(d.competitor_prices()), 0)
    recs = jobs.Snapshot(spark, base + "/recs")
    sink = jobs.pricing_from_state(jobs.Pricing(spark, base, "3 days 90 minutes", buckets=4), prices, d.products(), recs)
    ev = d.clickstream().orderBy("timestamp").cache()
    cuts = [r[0] for r in ev.select("timestamp").where("timestamp is not null").collect()]
    seen = None
    for i, part in enumerate((0.3, 0.31, 0.7, 1.0)):
        upto = ev.where(F.col("timestamp") <= F.lit(cuts[int(part * (len(cuts) - 1))]))
        batch = upto if seen is None else upto.where(F.col("timestamp") > F.lit(seen))
        sink(batch, i)
        if i == 1:
            sink(batch, i)  # replay
        seen = upto.agg(F.max("timestamp")).first()[0]
        want = pricing_cycle(d.products(), upto, d.competitor_prices(), lookback="3 days 90 minutes")
        key = lambda df: sorted(map(tuple, df.drop("timestamp").collect()))
        assert key(recs.read()) == key(want)
