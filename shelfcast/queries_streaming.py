"""Query registrations for sources/sinks (S*) and streaming jobs (T*).

Streaming queries run ``availableNow`` over the test tables into a fresh
folder under the shared checkpoint directory and return what the sink wrote.
"""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .operators.upsert import append_dedup, upsert
from .operators.latest import latest_by
from .plans.pricing import pricing_cycle
from .plans.staging import COMPETITOR_ORDER
from .plans.state import seed_inventory, seed_metrics, skipped_stock_changes
from .registry import DEMAND_LOOKBACK, register
from .session import scratch_path
from .sources import fixtures, lake, streams
from .streaming import jobs

AVAILABLE_NOW = {"availableNow": True}


def _run_dir(d, key):
    return scratch_path(d.spark, "runs", f"{key}-{uuid.uuid4().hex[:12]}")


def _await(q):
    q.awaitTermination()
    return q


def _ntz(df, *cols):
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return df


# ---------------------------------------------------------------- sources and sinks
@register("s2_parse_events")
def _s2(d):
    raw = fixtures.load(d.spark, d.data_dir, "events")
    msgs = raw.select(F.to_json(F.struct(*raw.columns)).alias("value"))
    good, _bad = streams.parse_events(msgs, raw.schema)
    return good.select("event_id", "user_id", "event_type", "value")


@register("s4_append_dedup")
def _s4(d):
    ev = d.clickstream()
    replayed = ev.unionByName(ev)          # every message delivered twice
    return append_dedup(replayed, None, "event_id").select("event_id", "event_type", "timestamp")


@register("s5_upsert")
def _s5(d):
    cp = d.competitor_prices()
    mid = cp.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).select(
        (F.col("a") + (F.col("b") - F.col("a")) / 2).alias("m")).scalar()
    cols = ["product_id", "competitor_name", "competitor_price", *COMPETITOR_ORDER[:-1]]
    current = latest_by(cp.filter(F.col("timestamp") <= mid).select(*cols), ["product_id", "competitor_name"],
                        COMPETITOR_ORDER)
    updates = cp.filter(F.col("timestamp") > mid).select(*cols)
    merged = upsert(current.select(*cols), updates, ["product_id", "competitor_name"], COMPETITOR_ORDER)
    return merged.select("product_id", "competitor_name", F.col("competitor_price").cast("double").alias("price"),
                         "timestamp")


@register("s7_seed_inventory")
def _s7(d):
    return seed_inventory(d.products(), d.warehouses())


@register("s7_seed_metrics")
def _s7_metrics(d):
    return seed_metrics(d.products()).withColumn("revenue", F.col("revenue").cast("double"))


@register("s8_read_since")
def _s8(d):
    ev = d.clickstream()
    since = ev.agg(F.max("timestamp") - F.expr(f"INTERVAL '{DEMAND_LOOKBACK}'")).scalar()
    return lake.read_since(ev, "timestamp", since).select("event_id", "event_type", "timestamp")


@register("s9_export_table")
def _s9(d):
    path = _run_dir(d, "lake_clickstream")
    lake.export_table(d.clickstream(), path)
    return d.spark.read.parquet(path).select("event_id", "event_type", "timestamp", "date")


@register("s10_coerce_for_lake")
def _s10(d):
    return lake.coerce_for_lake(d.clickstream(), ["event_id", "user_id", "product_id"]).select(
        "event_id", "user_id", "product_id", "product_price")


@register("s12_export_all")
def _s12(d):
    root = _run_dir(d, "lake")
    targets = {"clickstream_events": (d.clickstream(), "timestamp"),
               "inventory_events": (d.inventory_events(), "timestamp"),
               "competitor_prices": (d.competitor_prices(), "timestamp")}
    first = lake.export_all(d.spark, targets, root + "/data", root + "/state")
    second = lake.export_all(d.spark, targets, root + "/data", root + "/state")  # nothing new: cursors hold
    return first.withColumn("run", F.lit(1)).unionByName(second.withColumn("run", F.lit(2)))


# ---------------------------------------------------------------- streaming
def _delivered_twice(d, base, table):
    """``table`` as a landing folder that holds all of it twice, each delivery read as a
    micro-batch: every message of the second is a repetition. A delivery keeps the
    table's own partitions; the source takes files by age."""
    data = fixtures.load(d.spark, d.data_dir, table)
    data.write.option("compression", "zstd").parquet(base + "/landing")
    files = len(d.spark.read.parquet(base + "/landing").inputFiles())
    data.write.mode("append").option("compression", "zstd").parquet(base + "/landing")
    return d.spark.readStream.schema(data.schema).option("maxFilesPerTrigger", files).parquet(base + "/landing")


def _replayed_events(d, base, batches=3):
    """``events`` as a landing folder in which every message lies twice, dealt by hash over
    as many files as there are shuffle partitions: each micro-batch has late and repeated
    messages."""
    ev = fixtures.load(d.spark, d.data_dir, "events")
    files = max(batches, int(d.spark.conf.get("spark.sql.shuffle.partitions")))
    again = ev.withColumn("_f", F.pmod(F.xxhash64("event_id", F.lit(1)), F.lit(files)))
    both = ev.withColumn("_f", F.pmod(F.xxhash64("event_id"), F.lit(files))).unionByName(again)
    both.repartition(files, "_f").drop("_f").write.parquet(base + "/landing")
    s = d.spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", -(-files // batches)).parquet(base + "/landing")
    return fixtures.clickstream_from(s)


@register("t2_stream_dedup")
def _t2(d):
    base = _run_dir(d, "t2")
    _await(jobs.start(_replayed_events(d, base), base + "/ckpt", sink=jobs.log_sink(base + "/log"), trigger=AVAILABLE_NOW))
    return d.spark.read.parquet(base + "/log").select("event_id", "event_type", "timestamp")


def _metrics_stream_result(d, key, fanout: bool):
    base = _run_dir(d, key)
    s = (_replayed_events(d, base) if fanout else
         fixtures.clickstream_from(streams.table_stream(d.spark, d.data_dir, "events")))
    snap = jobs.Snapshot(d.spark, base + "/metrics")
    if fanout:
        sink = jobs.clickstream_fanout(d.spark, s, base + "/log", snap)
        _await(jobs.start(s, base + "/ckpt", sink=sink, trigger=AVAILABLE_NOW))
    else:
        agg = jobs.running_product_metrics(s)
        up = jobs.upsert_sink(snap, ["product_id"], ["_batch"])
        _await(jobs.start(agg, base + "/ckpt", output_mode="update", trigger=AVAILABLE_NOW,
                          sink=lambda b, i: up(b.withColumn("_batch", F.lit(i)), i)))
    return snap.read().select("product_id", "total_views", "total_cart_adds", "total_purchases",
                              F.col("revenue").cast("double").alias("revenue"))


register("t3_stream_fanout")(lambda d: _metrics_stream_result(d, "t3", True))
register("t4_stream_product_metrics")(lambda d: _metrics_stream_result(d, "t4", False))


@register("t5_stream_guarded_stock")
def _t5(d):
    base = _run_dir(d, "t5")
    s = fixtures.inventory_events_from(_delivered_twice(d, base, "lineitem"))
    snap = jobs.Snapshot(d.spark, base + "/stock")
    _await(jobs.start(s, base + "/ckpt", sink=jobs.stock_sink(snap, base + "/log"), trigger=AVAILABLE_NOW))
    return snap.read().select("product_id", "warehouse_id", "current_stock")


def _latest_prices(d, base):
    """T6 over the whole table of prices: the snapshot that it keeps."""
    part = fixtures.load(d.spark, d.data_dir, "part")
    s = fixtures.competitor_prices_from(streams.table_stream(d.spark, d.data_dir, "lineitem"), part)
    snap = jobs.Snapshot(d.spark, base + "/latest")
    up = jobs.upsert_sink(snap, ["product_id", "competitor_name"], ["_batch"])
    _await(jobs.start(jobs.latest_competitor_prices(s), base + "/ckpt", output_mode="update",
                      trigger=AVAILABLE_NOW, sink=lambda b, i: up(b.withColumn("_batch", F.lit(i)), i)))
    return snap


@register("t6_stream_competitor_latest")
def _t6(d):
    return _latest_prices(d, _run_dir(d, "t6")).read().select("product_id", "competitor_name",
                              F.col("competitor_price").cast("double").alias("competitor_price"),
                              F.col("timestamp").alias("observed_at"))


@register("t7_stream_pricing")
def _t7(d):
    """Every trigger adds the batch's new messages to the event log and recomputes the
    recommendations as of the newest event so far; the demand look-back only reads the
    log partitions it needs (partition pruning on ``date``)."""
    base = _run_dir(d, "t7")
    s = _replayed_events(d, base)
    recs = jobs.Snapshot(d.spark, base + "/recs")
    log = base + "/log"
    spark = d.spark

    def build(batch, batch_id):
        new = jobs.append_new(batch, log, batch_id)
        newest = batch.agg(F.to_date(F.max("timestamp"))).first()[0]        # one scalar per trigger
        events = jobs.event_log(spark, log, new.schema).filter(F.col("batch") <= batch_id).drop("batch")
        as_of = events.filter(F.col("date") >= newest).agg(F.max("timestamp")).first()[0]
        recent = lake.read_since(events, "timestamp",
                                 F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL '{DEMAND_LOOKBACK}'"))
        return pricing_cycle(d.products(), recent.drop("date"), d.competitor_prices(),
                             as_of=F.lit(as_of).cast("timestamp_ntz"), lookback=DEMAND_LOOKBACK)
    _await(jobs.start(s, base + "/ckpt", sink=jobs.pricing_trigger(spark, recs, build), trigger=AVAILABLE_NOW))
    return recs.read()


@register("t7_pricing_from_state")
def _t7_state(d):
    """Every trigger prices from kept state: panes of purchases, the newest time, and the
    latest price per (product, competitor) of the price stream."""
    base = _run_dir(d, "t7s")
    prices = _latest_prices(d, base + "/prices")
    recs = jobs.Snapshot(d.spark, base + "/recs")
    sink = jobs.pricing_from_state(jobs.Pricing(d.spark, base, DEMAND_LOOKBACK), prices, d.products(), recs)
    _await(jobs.start(_replayed_events(d, base), base + "/ckpt", sink=sink, trigger=AVAILABLE_NOW))
    return recs.read()


@register("t8_stream_throughput")
def _t8(d):
    base = _run_dir(d, "t8")
    s = fixtures.clickstream_from(streams.table_stream(d.spark, d.data_dir, "events"))
    out = jobs.throughput(s, window="1 hour", seconds=3600.0, delay="1 hour")
    _await(jobs.start(out, base + "/ckpt", trigger=AVAILABLE_NOW, fmt="parquet", path=base + "/out"))
    return _ntz(d.spark.read.parquet(base + "/out"), "window_start", "window_end")


@register("t10_stream_lake_archive")
def _t10(d):
    base = _run_dir(d, "t10")
    s = fixtures.clickstream_from(streams.table_stream(d.spark, d.data_dir, "events")) \
        .withColumn("date", F.to_date("timestamp"))
    _await(jobs.start(s, base + "/ckpt", trigger=AVAILABLE_NOW, fmt="parquet", path=base + "/lake",
                      partition_by=["date"]))
    return d.spark.read.parquet(base + "/lake").select("event_id", "event_type", "date")


def _three_streams(d):
    part = fixtures.load(d.spark, d.data_dir, "part")
    lines = lambda: streams.table_stream(d.spark, d.data_dir, "lineitem")  # noqa: E731  (one source a stream)
    return {"clickstream_events": fixtures.clickstream_from(streams.table_stream(d.spark, d.data_dir, "events")),
            "inventory_events": fixtures.inventory_events_from(lines()),
            "competitor_prices": fixtures.competitor_prices_from(lines(), part)}


@register("t8_throughput_by_stream")
def _t8_all(d):
    """Throughput of all three streams, one query."""
    base = _run_dir(d, "t8a")
    out = jobs.throughput(jobs.named_streams(_three_streams(d)), window="1 day", seconds=86400.0, delay="1 day", by=["stream"])
    _await(jobs.start(out, base + "/ckpt", trigger=AVAILABLE_NOW, fmt="parquet", path=base + "/out"))
    return _ntz(d.spark.read.parquet(base + "/out"), "window_start", "window_end")


@register("t10_lake_archive_all")
def _t10_all(d):
    """Each of the three streams into its own table of the lake, by date: rows a table and date."""
    base = _run_dir(d, "t10a")
    out = None
    for name, s in _three_streams(d).items():
        _await(jobs.start(s.withColumn("date", F.to_date("timestamp")).repartition("date"), f"{base}/ckpt/{name}", trigger=AVAILABLE_NOW,
                          fmt="parquet", path=f"{base}/lake/{name}", partition_by=["date"]))
        one = d.spark.read.parquet(f"{base}/lake/{name}").groupBy(F.lit(name).alias("table"), "date").agg(F.count("*").alias("n_rows"))
        out = one if out is None else out.unionByName(one)
    return out


@register("t11_skipped_stock_changes")
def _t11(d):
    return skipped_stock_changes(d.inventory_events()).select(
        "product_id", "warehouse_id", "quantity_change", "timestamp", "src_order", "src_line", "reason")
