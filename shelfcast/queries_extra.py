"""Remaining inventory rows: the pricing rule on its own (E3), scans and stream
sources (S1, S3), catalogue upsert (S6), export cursor (S11), materialisation
(S13), triggers (T1) and dead-letter isolation of stream messages (T9)."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from .functions.columns import recommend
from .operators.upsert import upsert
from .oracle import q
from .plans import demand, marts, staging
from .plans.pricing import avg_competitor_price, demand_velocity
from .registry import DEMAND_LOOKBACK, recs_of, register
from .session import scratch_path
from .sources import lake, streams, topics
from .sources.tables import load
from .streaming import jobs


def reg(key, sql, extra=None):
    def deco(fn):
        register(key)(fn)
        if sql is not None:
            q(key, sql, extra)
        return fn
    return deco


def _mart_ctes():
    from . import oracle_core  # noqa: F401
    from .oracle import BODIES
    return {"daily_funnel_metrics": BODIES["x3_daily_funnel_metrics"], "hourly_demand": BODIES["x2_hourly_demand"]}


def _run_dir(d, key):
    return scratch_path(d.spark, "runs", f"{key}-{uuid.uuid4().hex[:12]}")


@reg("e3_recommend", """
SELECT product_id, recommendation, recommended_price, confidence_score FROM recs""")
def _e3(d):
    j = (d.products().join(avg_competitor_price(d.competitor_prices()), "product_id")
         .join(demand_velocity(d.clickstream(), lookback=DEMAND_LOOKBACK), "product_id", "left"))
    r = recommend(F.col("base_price"), F.col("avg_competitor_price"), F.coalesce(F.col("demand_velocity"), F.lit(0.0)))
    return j.select("product_id", r["recommendation"].alias("recommendation"),
                    r["recommended_price"].alias("recommended_price"), r["confidence_score"].alias("confidence_score"))


@reg("s3_table_scan", "SELECT p_partkey, p_name, p_type, p_retailprice FROM part")
def _s3(d):
    return load(d.spark, d.data_dir, "part").select("p_partkey", "p_name", "p_type", "p_retailprice")


@reg("s1_stream_source", "SELECT event_id, ts, event_type FROM events")
def _s1(d):
    base = _run_dir(d, "s1")
    s = streams.table_stream(d.spark, d.data_dir, "events").select("event_id", "ts", "event_type")
    jobs.start(s, base + "/ckpt", trigger={"availableNow": True}, fmt="parquet", path=base + "/out").awaitTermination()
    return d.spark.read.parquet(base + "/out")


@reg("s6_catalog_upsert", """
SELECT p.product_id, p.product_name, p.category,
       CASE WHEN r.product_id IS NULL THEN CAST(p.base_price AS DOUBLE) ELSE r.recommended_price END AS base_price,
       CASE WHEN r.product_id IS NULL THEN 0 ELSE 1 END AS version
FROM products p LEFT JOIN recs r ON p.product_id = r.product_id""")
def _s6(d):
    """Catalogue upsert: the recommendations re-price the products they cover
    (update), everything else keeps its row (no-op); a later version wins."""
    cur = d.products().select("product_id", "product_name", "category",
                              F.col("base_price").cast("double").alias("base_price"), F.lit(0).alias("version"))
    upd = (recs_of(d).join(d.products().select("product_id", "category"), "product_id")
           .select("product_id", "product_name", "category", F.col("recommended_price").alias("base_price"),
                   F.lit(1).alias("version")))
    return upsert(cur, upd, ["product_id"], ["version"])


@reg("s11_export_cursor", """
SELECT 'clickstream_events' AS "table", strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS cursor FROM clickstream""")
def _s11(d):
    base = _run_dir(d, "s11")
    ev = d.clickstream()
    lake.export_table(ev, base + "/lake")
    last = ev.agg(F.max("timestamp")).first()[0]       # one scalar
    lake.save_cursor(d.spark, base + "/state", "clickstream_events", last)
    return d.spark.createDataFrame([("clickstream_events", lake.load_cursor(d.spark, base + "/state",
                                                                            "clickstream_events"))],
                                   "table string, cursor string")


@reg("s13_materialize", """
SELECT 'daily_funnel_metrics' AS name, 'table' AS kind, (SELECT count(*) FROM daily_funnel_metrics) AS n_rows
UNION ALL SELECT 'hourly_demand', 'table', (SELECT count(*) FROM hourly_demand)
UNION ALL SELECT 'stg_clickstream', 'view', (SELECT count(*) FROM clickstream)
UNION ALL SELECT 'stg_inventory', 'view', (SELECT count(*) FROM inventory_events)""", _mart_ctes())
def _s13(d):
    base = _run_dir(d, "s13")
    ev, products = d.clickstream(), d.products()
    views = {"stg_clickstream": staging.stg_clickstream(ev), "stg_inventory": staging.stg_inventory(d.inventory_events())}
    tables = {"daily_funnel_metrics": marts.daily_funnel_metrics(ev, products),
              "hourly_demand": marts.hourly_demand(ev, products)}
    lake.materialize(d.spark, views, tables, base)
    counts = [(n, "table", d.spark.read.parquet(f"{base}/{n}").count()) for n in tables] + \
             [(n, "view", d.spark.table(n).count()) for n in views]
    return d.spark.createDataFrame(counts, "name string, kind string, n_rows bigint")


@reg("t1_trigger_batches", "SELECT CAST(0 AS BIGINT) AS batch_id, count(*) AS n_rows FROM events")
def _t1(d):
    """One micro-batch per new file (maxFilesPerTrigger = 1); each batch reports its size."""
    base = _run_dir(d, "t1")
    s = streams.table_stream(d.spark, d.data_dir, "events", max_files_per_trigger=1)

    def sink(batch, batch_id):
        batch.agg(F.lit(batch_id).cast("bigint").alias("batch_id"), F.count(F.lit(1)).alias("n_rows")) \
            .write.mode("overwrite").parquet(f"{base}/sizes/b={batch_id}")
    jobs.start(s, base + "/ckpt", sink=sink, trigger={"availableNow": True}).awaitTermination()
    return d.spark.read.parquet(base + "/sizes").drop("b")


def _json_landing(d, base, batches=4):
    """``events`` as JSON lines in as many files as there are shuffle partitions; every
    97th line is cut short."""
    ev = load(d.spark, d.data_dir, "events")
    files = max(batches, int(d.spark.conf.get("spark.sql.shuffle.partitions")))
    line = F.to_json(F.struct(*ev.columns))
    broken = F.when(F.col("event_id") % 97 == 0, F.substring(line, 1, 20)).otherwise(line)
    ev.select("event_id", broken.alias("value")).repartition(files, "event_id").drop("event_id").write.text(base + "/landing")
    return streams.parse_events(streams.json_lines_stream(d.spark, base + "/landing", max_files_per_trigger=-(-files // batches)), ev.schema)


@reg("t9_dead_letter_isolation", """
SELECT event_id, user_id, event_type, CAST(NULL AS VARCHAR) AS raw_message FROM events WHERE event_id % 97 <> 0
UNION ALL SELECT NULL, NULL, NULL, substr('{"event_id":' || event_id || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S'), 1, 20)
FROM events WHERE event_id % 97 = 0""")
def _t9(d):
    """Messages land as JSON lines; the stream decodes them and routes any
    undecodable line to a dead-letter folder instead of failing. Returns both."""
    base = _run_dir(d, "t9")
    good, bad = _json_landing(d, base)
    jobs.start(good.select("event_id", "user_id", "event_type"), base + "/ckpt", trigger={"availableNow": True},
               fmt="parquet", path=base + "/good").awaitTermination()
    jobs.start(bad, base + "/ckpt_bad", trigger={"availableNow": True}, fmt="parquet",
               path=base + "/dead_letter").awaitTermination()
    return d.spark.read.parquet(base + "/good").unionByName(
        d.spark.read.parquet(base + "/dead_letter"), allowMissingColumns=True)


@reg("s1_json_source", "SELECT event_id, user_id, event_type, value FROM events WHERE event_id % 97 <> 0")
def _s1_json(d):
    """JSON message source: typed columns of the decodable lines, one file a batch."""
    base = _run_dir(d, "s1j")
    good, _ = _json_landing(d, base)
    jobs.start(good.select("event_id", "user_id", "event_type", "value"), base + "/ckpt", trigger={"availableNow": True},
               fmt="parquet", path=base + "/out").awaitTermination()
    return d.spark.read.parquet(base + "/out")


@reg("t1_trigger_files", "SELECT count(DISTINCT CAST(ts AS DATE)) AS n_batches, count(*) AS n_rows FROM events")
def _t1_files(d):
    """One micro-batch a landed file: the number of batches that had rows, and rows."""
    base = _run_dir(d, "t1f")
    ev = load(d.spark, d.data_dir, "events").withColumn("day", F.to_date("ts"))
    ev.repartition("day").write.partitionBy("day").parquet(base + "/landing")  # a file a day
    s = d.spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(base + "/landing")

    def sink(batch, batch_id):
        batch.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{base}/sizes/b={batch_id}")
    jobs.start(s, base + "/ckpt", sink=sink, trigger={"availableNow": True}).awaitTermination()
    return d.spark.read.parquet(base + "/sizes").agg(F.count_if(F.col("n") > 0).alias("n_batches"), F.sum("n").alias("n_rows"))


def _messages(rows):
    """Rows as JSON messages; those of every 97th product are cut short."""
    line = F.to_json(F.struct(*rows.columns), {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"})
    return rows.select(F.when(F.col("product_id") % 97 == 0, F.substring(line, 1, 20)).otherwise(line).alias("value"))


def _land_twice(rows, path, name):
    """Deliver messages twice: the second delivery repeats the first as it was written."""
    topics.land(rows, path, name, "0")
    topics.land(rows.sparkSession.read.schema("value string").parquet(f"{path}/{name}/0"), path, name, "1")


def _feeds(d):
    """The rows of the three topics; a price observation is identified by what tells two apart."""
    cp = d.competitor_prices()
    seen = F.concat_ws("|", "product_id", "competitor_name", "src_order", "src_line", "competitor_price", "timestamp")
    return {"clickstream_events": (d.clickstream(), "day"), "inventory_events": (d.inventory_events(), "month"),
            "competitor_prices": (cp.select(seen.alias("event_id"), *cp.columns), "month")}


_RECEIVED = """
  SELECT 'clickstream_events' AS topic, CAST(event_id AS VARCHAR) AS id, product_id FROM clickstream
  UNION ALL SELECT 'inventory_events', CAST(event_id AS VARCHAR), product_id FROM inventory_events
  UNION ALL SELECT 'competitor_prices', concat_ws('|', product_id, competitor_name, src_order, src_line, competitor_price, timestamp),
                   product_id FROM competitor_prices"""


@reg("t1_three_topic_ingest", f"""
SELECT topic, 2 * count(*) AS received, count(DISTINCT CASE WHEN ok THEN id END) AS kept,
       2 * count(*) FILTER (WHERE ok) - count(DISTINCT CASE WHEN ok THEN id END) AS duplicates,
       2 * count(*) FILTER (WHERE NOT ok) AS errors
FROM (SELECT *, coalesce(product_id % 97 <> 0, true) AS ok FROM ({_RECEIVED})) GROUP BY topic""")
def _t1_ingest(d):
    """Three topics from one entry, every message delivered twice: counters of each stream."""
    base, feeds = _run_dir(d, "t1i"), _feeds(d)
    n = 0
    for name, (rows, _) in feeds.items():
        _land_twice(_messages(rows), base + "/landing", name)
        n += 2 * d.spark.read.parquet(f"{base}/landing/{name}/0").count()
    s = topics.topic_stream(d.spark, base + "/landing", list(feeds), base + "/admitted", starting="earliest", max_records=-(-n // 4))
    sink = jobs.ingest_sink(base, {name: jobs.Feed(rows.schema, unit=unit) for name, (rows, unit) in feeds.items()})
    jobs.drain(jobs.start(s, base + "/ckpt", sink=sink, trigger={"processingTime": "0 seconds"}), topics.MAX_DELAY)
    return jobs.stream_counters(d.spark, base)


@reg("t1_size_or_time", """
SELECT CAST(ceil(n / ceil(n / 7.0)) AS BIGINT) AS n_batches, CAST(ceil(n / 7.0) AS BIGINT) AS largest, n AS n_rows
FROM (SELECT count(*) AS n FROM events)""")
def _t1_size(d):
    """Batches by count of messages: all events in batches of a seventh, the rest after the delay."""
    base, ev = _run_dir(d, "t1z"), load(d.spark, d.data_dir, "events")
    topics.land(ev.select(F.to_json(F.struct(*ev.columns)).alias("value")), base + "/landing", "events", "0")
    size = -(-d.spark.read.parquet(base + "/landing/events/0").count() // 7)
    s = topics.topic_stream(d.spark, base + "/landing", ["events"], base + "/admitted", starting="earliest",
                            min_records=max(size, 1), max_records=max(size, 1))

    def sink(batch, batch_id):
        batch.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{base}/sizes/b={batch_id}")
    jobs.drain(jobs.start(s, base + "/ckpt", sink=sink, trigger={"processingTime": "0 seconds"}), topics.MAX_DELAY)
    return d.spark.read.parquet(base + "/sizes").where("n > 0").agg(
        F.count("*").alias("n_batches"), F.max("n").alias("largest"), F.sum("n").alias("n_rows"))


def _forecast_ctes():
    from . import oracle_analytics
    from .oracle import BODIES
    return {**oracle_analytics.HC, "fc": BODIES["g9_demand_forecast"]}


# The categories (part types) of the catalogue.
CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@reg("h4_forecast_wide", "SELECT hour, " + ", ".join(
    f"max(forecast_purchases) FILTER (WHERE category = '{c}') AS \"{c}\"" for c in CATEGORIES) + " FROM fc GROUP BY hour",
    _forecast_ctes())
def _h4_forecast(d):
    """The forecast with one column per category."""
    hourly = demand.hourly_category_demand(d.clickstream(), d.products())
    return demand.forecast_wide(demand.demand_forecast(hourly), CATEGORIES)
