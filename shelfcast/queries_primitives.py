"""Minimal queries for the primitive operator rows of the inventory (P, J, A, W,
L, F, H), each next to its oracle SQL. Every one reads the test tables in full
and exercises the library function (or Spark primitive) named in the survey."""
from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .functions.columns import (DEVICES, DOW_LABELS, EVENT_TYPES, FUNNEL_STAGES, WAREHOUSES, in_list_position,
                                iso_dow, rnd, safe_div, seconds_between, stock_band, title_words)
from .operators import describe_by, histogram, box_summary, latest_by, quantile_bins, stage_sessions
from .operators.distinct import distinct_counts
from .operators.grid import densify, int_axis
from .oracle import R, q, staged
from .plans import demand as G
from .plans import funnel as U
from .plans.common import within_lookback
from .registry import DEMAND_LOOKBACK, metrics_of, recs_of, register, stock_of
from .session import materialize

PUR = "event_type = 'purchase'"


def reg(key, sql, extra=None):
    def deco(fn):
        register(key)(fn)
        if sql is not None:
            q(key, sql, extra)
        return fn
    return deco


def _pur(d):
    return d.clickstream().filter(F.col("event_type") == "purchase")


# ---------------------------------------------------------------- P: projections / filters
@reg("p3_filter_predicates", f"SELECT event_id, product_id FROM clickstream WHERE {PUR} AND product_id IS NOT NULL")
def _p3(d):
    return d.clickstream().filter((F.col("event_type") == "purchase") & F.col("product_id").isNotNull()) \
        .select("event_id", "product_id")


@reg("p4_trailing_time_filter", """
SELECT event_id, timestamp FROM clickstream WHERE timestamp > (SELECT t FROM ev_as_of) - INTERVAL '24 hours'""")
def _p4(d):
    return within_lookback(d.clickstream(), "24 hours").select("event_id", "timestamp")


@reg("p5_range_predicates", """
SELECT product_id, competitor_name, CAST(price_difference_pct AS DOUBLE) AS price_difference_pct, timestamp
FROM competitor_prices WHERE price_difference_pct < -15 OR price_difference_pct > 15 OR competitor_price <= 0""")
def _p5(d):
    cp = d.competitor_prices()
    return cp.filter(~F.col("price_difference_pct").between(-15, 15) | (F.col("competitor_price") <= 0)).select(
        "product_id", "competitor_name", F.col("price_difference_pct").cast("double").alias("price_difference_pct"),
        "timestamp")


@reg("p6_not_in_list", "SELECT event_id, event_type FROM clickstream WHERE event_type NOT IN ('page_view', 'purchase')")
def _p6(d):
    return d.clickstream().filter(~F.col("event_type").isin("page_view", "purchase")).select("event_id", "event_type")


@reg("p7_case_labels", """
SELECT product_id, warehouse_id, current_stock,
       CASE WHEN current_stock < 10 THEN 'red' WHEN current_stock < 30 THEN 'amber' ELSE 'green' END AS band
FROM stock""")
def _p7(d):
    s = stock_of(d)
    return s.select("product_id", "warehouse_id", "current_stock", stock_band(F.col("current_stock")).alias("band"))


@reg("p8_label_subset", "SELECT product_id, recommendation FROM recs WHERE recommendation IN ('raise', 'lower')")
def _p8(d):
    return recs_of(d).filter(F.col("recommendation").isin("raise", "lower")).select("product_id", "recommendation")


@reg("p9_value_mapping", """
SELECT event_id, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][isodow(timestamp)] AS day_name,
       CASE WHEN event_type = 'purchase' THEN 'Converted' ELSE 'Not Converted' END AS outcome
FROM clickstream""")
def _p9(d):
    labels = F.array(*[F.lit(x) for x in DOW_LABELS])
    return d.clickstream().select("event_id", F.element_at(labels, iso_dow(F.col("timestamp"))).alias("day_name"),
                                  F.when(F.col("event_type") == "purchase", "Converted")
                                  .otherwise("Not Converted").alias("outcome"))


@reg("p10_rename_select", """
SELECT warehouse_id AS warehouse, product_id AS product, quantity_change AS qty, timestamp AS event_timestamp
FROM inventory_events""")
def _p10(d):
    return (d.inventory_events().withColumnRenamed("warehouse_id", "warehouse").withColumnRenamed("product_id", "product")
            .withColumnRenamed("quantity_change", "qty").withColumnRenamed("timestamp", "event_timestamp")
            .select("warehouse", "product", "qty", "event_timestamp"))


# ---------------------------------------------------------------- J: joins
@reg("j1_inner_join_product", """
SELECT c.event_id, p.category FROM clickstream c JOIN products p ON c.product_id = p.product_id""")
def _j1(d):
    return d.clickstream().join(d.products(), "product_id").select("event_id", "category")


@reg("j2_left_join_unknown", """
SELECT c.event_id, coalesce(p.category, 'unknown') AS category
FROM clickstream c LEFT JOIN products p ON c.product_id = p.product_id""")
def _j2(d):
    return d.clickstream().join(d.products(), "product_id", "left").select(
        "event_id", F.coalesce(F.col("category"), F.lit("unknown")).alias("category"))


@reg("j3_left_join_preaggregates", """
SELECT p.product_id, coalesce(b.n, 0) AS purchases, coalesce(o.n, 0) AS observations
FROM products p
LEFT JOIN (SELECT product_id, count(*) AS n FROM clickstream WHERE event_type = 'purchase' GROUP BY 1) b
  ON p.product_id = b.product_id
LEFT JOIN (SELECT product_id, count(*) AS n FROM competitor_prices GROUP BY 1) o ON p.product_id = o.product_id""")
def _j3(d):
    b = _pur(d).groupBy("product_id").agg(F.count(F.lit(1)).alias("b"))
    o = d.competitor_prices().groupBy("product_id").agg(F.count(F.lit(1)).alias("o"))
    j = d.products().select("product_id").join(b, "product_id", "left").join(o, "product_id", "left")
    return j.select("product_id", F.coalesce("b", F.lit(0)).alias("purchases"),
                    F.coalesce("o", F.lit(0)).alias("observations"))


@reg("j4_three_way_join", """
SELECT r.product_id, p.category, m.total_purchases, r.recommendation
FROM recs r JOIN products p ON r.product_id = p.product_id JOIN metrics m ON r.product_id = m.product_id""")
def _j4(d):
    return (recs_of(d).join(d.products().select("product_id", "category"), "product_id")
            .join(metrics_of(d).select("product_id", "total_purchases"), "product_id")
            .select("product_id", "category", "total_purchases", "recommendation"))


@reg("j5_cross_join_seed", """
SELECT p.product_id, w.warehouse_id FROM products p CROSS JOIN warehouses w""")
def _j5(d):
    return d.products().select("product_id").crossJoin(F.broadcast(d.warehouses()))


@reg("j6_anti_join", """
SELECT product_id FROM products
WHERE product_id NOT IN (SELECT product_id FROM clickstream WHERE product_id IS NOT NULL)""")
def _j6(d):
    ev = d.clickstream().filter(F.col("product_id").isNotNull()).select("product_id")
    return d.products().select("product_id").join(ev, "product_id", "left_anti")


@reg("j7_not_exists_insert", """
WITH m AS (SELECT min(timestamp) + (max(timestamp) - min(timestamp)) / 2 AS t FROM competitor_prices)
SELECT DISTINCT u.product_id, u.competitor_name FROM competitor_prices u, m
WHERE u.timestamp > m.t AND NOT EXISTS (
  SELECT 1 FROM competitor_prices c, m m2
  WHERE c.timestamp <= m2.t AND c.product_id = u.product_id AND c.competitor_name = u.competitor_name)""")
def _j7(d):
    cp = d.competitor_prices()
    mid = cp.agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b")).select(
        (F.col("a") + (F.col("b") - F.col("a")) / 2).alias("m")).scalar()
    keys = ["product_id", "competitor_name"]
    current = cp.filter(F.col("timestamp") <= mid).select(*keys)
    return cp.filter(F.col("timestamp") > mid).select(*keys).distinct().join(current, keys, "left_anti")


@reg("j8_merge_inner", """
SELECT p.user_id, p.device_type, p.purchase_count, r.frequency
FROM (SELECT user_id, device_type, count(*) AS purchase_count FROM clickstream WHERE event_type = 'purchase'
      GROUP BY 1, 2) p
JOIN (SELECT user_id, count(*) AS frequency FROM clickstream WHERE event_type = 'purchase' GROUP BY 1) r
  ON p.user_id = r.user_id""")
def _j8(d):
    p = _pur(d).groupBy("user_id", "device_type").agg(F.count(F.lit(1)).alias("purchase_count"))
    r = _pur(d).groupBy("user_id").agg(F.count(F.lit(1)).alias("frequency"))
    return p.join(r, "user_id")


@reg("j9_lookup_default", """
SELECT p.product_id, coalesce(d.demand_velocity, 0.0) AS demand_velocity
FROM products p LEFT JOIN demand d ON p.product_id = d.product_id""")
def _j9(d):
    from .plans.pricing import demand_velocity
    dv = demand_velocity(d.clickstream(), lookback=DEMAND_LOOKBACK)
    return d.products().select("product_id").join(dv, "product_id", "left").select(
        "product_id", F.coalesce(F.col("demand_velocity"), F.lit(0.0)).alias("demand_velocity"))


@reg("j10_scalar_subqueries", """
SELECT (SELECT count(*) FROM products) AS total_products, (SELECT count(*) FROM clickstream) AS total_events,
       (SELECT count(*) FROM competitor_prices) AS total_observations""")
def _j10(d):
    return (d.products().agg(F.count(F.lit(1)).alias("total_products"))
            .crossJoin(d.clickstream().agg(F.count(F.lit(1)).alias("total_events")))
            .crossJoin(d.competitor_prices().agg(F.count(F.lit(1)).alias("total_observations"))))


# ---------------------------------------------------------------- A: aggregations
@reg("a1_global_aggregates", f"""
SELECT count(*) AS n, min(timestamp) AS first_ts, max(timestamp) AS last_ts,
       CAST(sum(product_price) AS DOUBLE) AS total_price, {R('avg(CAST(product_price AS DOUBLE))', 4)} AS avg_price
FROM clickstream""")
def _a1(d):
    return d.clickstream().agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("first_ts"),
                               F.max("timestamp").alias("last_ts"),
                               F.sum("product_price").cast("double").alias("total_price"),
                               rnd(F.avg(F.col("product_price").cast("double")), 4).alias("avg_price"))


@reg("a2_group_count", "SELECT device_type, event_type, count(*) AS n FROM clickstream GROUP BY 1, 2")
def _a2(d):
    return d.clickstream().groupBy("device_type", "event_type").agg(F.count(F.lit(1)).alias("n"))


@reg("a3_count_distinct", """
SELECT count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
       count(DISTINCT (user_id, device_type)) AS user_devices FROM clickstream""")
def _a3(d):
    return distinct_counts(d.clickstream(), {"users": "user_id", "sessions": "session_id",
                                             "user_devices": ["user_id", "device_type"]})


@reg("a4_conditional_distinct", staged("day", "(SELECT *, CAST(timestamp AS DATE) AS day FROM clickstream)"))
def _a4(d):
    return stage_sessions(d.clickstream().withColumn("day", F.to_date("timestamp")), ["day"])


@reg("a5_count_filter", """
SELECT device_type, count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
       count(*) FILTER (WHERE event_type = 'product_view') AS product_views FROM clickstream GROUP BY 1""")
def _a5(d):
    t = F.col("event_type")
    return d.clickstream().groupBy("device_type").agg(F.count_if(t == "purchase").alias("purchases"),
                                                      F.count_if(t == "product_view").alias("product_views"))


@reg("a6_avg_filter", f"""
SELECT device_type, {R("avg(CAST(product_price AS DOUBLE)) FILTER (WHERE event_type = 'purchase')", 4)} AS avg_purchase_price
FROM clickstream GROUP BY 1""")
def _a6(d):
    return d.clickstream().groupBy("device_type").agg(rnd(F.avg(F.when(
        F.col("event_type") == "purchase", F.col("product_price").cast("double"))), 4).alias("avg_purchase_price"))


@reg("a7_sum_case_rate", f"""
SELECT competitor_name, {R('sum(CASE WHEN competitor_price < our_price THEN 1 ELSE 0 END) * 100.0 / nullif(count(*), 0)', 2)} AS pct_cheaper
FROM competitor_prices GROUP BY 1""")
def _a7(d):
    cheaper = F.when(F.col("competitor_price") < F.col("our_price"), 1).otherwise(0)
    return d.competitor_prices().groupBy("competitor_name").agg(
        rnd(safe_div(F.sum(cheaper) * 100.0, F.count(F.lit(1))), 2).alias("pct_cheaper"))


@reg("a8_bool_or", "SELECT session_id, bool_or(event_type = 'purchase') AS converted FROM clickstream GROUP BY 1")
def _a8(d):
    return d.clickstream().groupBy("session_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("converted"))


@reg("a9_having", f"SELECT user_id, count(*) AS purchases FROM clickstream WHERE {PUR} GROUP BY 1 HAVING count(*) > 0")
def _a9(d):
    return _pur(d).groupBy("user_id").agg(F.count(F.lit(1)).alias("purchases")).filter(F.col("purchases") > 0)


@reg("a10_two_level_aggregation", """
SELECT events_in_session, count(*) AS sessions FROM (
  SELECT session_id, count(*) AS events_in_session FROM clickstream GROUP BY 1) GROUP BY 1""")
def _a10(d):
    return d.clickstream().groupBy("session_id").agg(F.count(F.lit(1)).alias("events_in_session")) \
        .groupBy("events_in_session").agg(F.count(F.lit(1)).alias("sessions"))


@reg("a11_rate_per_hour", f"""
SELECT device_type, {R('count(*) / nullif(epoch(max(timestamp) - min(timestamp)) / 3600.0, 0)', 4)} AS purchases_per_hour
FROM clickstream WHERE {PUR} GROUP BY 1""")
def _a11(d):
    return _pur(d).groupBy("device_type").agg(rnd(safe_div(
        F.count(F.lit(1)), seconds_between(F.max("timestamp"), F.min("timestamp")) / 3600.0), 4)
        .alias("purchases_per_hour"))


@reg("a12_pivot_max", "SELECT product_id, " + ", ".join(
    f"coalesce(max(quantity_change) FILTER (WHERE warehouse_id = '{w}'), 0) AS \"{w}\"" for w in WAREHOUSES)
    + " FROM inventory_events GROUP BY 1")
def _a12(d):
    pv = d.inventory_events().groupBy("product_id").pivot("warehouse_id", WAREHOUSES).agg(F.max("quantity_change"))
    return pv.select("product_id", *[F.coalesce(F.col(f"`{w}`"), F.lit(0)).alias(w) for w in WAREHOUSES])


@reg("a13_pivot_mean", "SELECT category, " + ", ".join(
    R(f"coalesce(avg(CAST(c.competitor_price AS DOUBLE)) FILTER (WHERE c.competitor_name = '{n}'), 0.0)", 2)
    + f" AS {n}" for n in ["TechMart", "GadgetZone", "ElectroHub"])
    + " FROM competitor_prices c JOIN products p ON c.product_id = p.product_id GROUP BY 1")
def _a13(d):
    j = d.competitor_prices().join(d.products().select("product_id", "category"), "product_id")
    names = ["TechMart", "GadgetZone", "ElectroHub"]
    pv = j.groupBy("category").pivot("competitor_name", names).agg(F.avg(F.col("competitor_price").cast("double")))
    return pv.na.fill(0.0).select("category", *[rnd(F.col(n), 2).alias(n) for n in names])


@reg("a14_group_stats", f"""
SELECT event_type, CAST(sum(product_price) AS DOUBLE) AS total, {R('avg(CAST(product_price AS DOUBLE))', 4)} AS mean,
       {R('stddev_samp(CAST(product_price AS DOUBLE))', 4)} AS std, count(product_price) AS n,
       {R('stddev_samp(CAST(product_price AS DOUBLE)) / nullif(avg(CAST(product_price AS DOUBLE)), 0)', 4)} AS cv
FROM clickstream GROUP BY 1""")
def _a14(d):
    v = F.col("product_price").cast("double")
    return d.clickstream().groupBy("event_type").agg(
        F.sum("product_price").cast("double").alias("total"), rnd(F.avg(v), 4).alias("mean"),
        rnd(F.stddev_samp(v), 4).alias("std"), F.count(v).alias("n"),
        rnd(safe_div(F.stddev_samp(v), F.avg(v)), 4).alias("cv"))


@reg("a15_describe", f"""
SELECT device_type, count(v) AS count, {R('avg(v)', 2)} AS mean, {R('stddev_samp(v)', 2)} AS std,
       {R('min(v)', 2)} AS min, {R('quantile_cont(v, 0.25)', 2)} AS q25, {R('quantile_cont(v, 0.5)', 2)} AS q50,
       {R('quantile_cont(v, 0.75)', 2)} AS q75, {R('max(v)', 2)} AS max
FROM (SELECT device_type, CAST(product_price AS DOUBLE) AS v FROM clickstream WHERE {PUR}) GROUP BY 1""")
def _a15(d):
    return describe_by(_pur(d), ["device_type"], "product_price")


@reg("a16_value_counts", "SELECT event_type, count(*) AS count FROM inventory_events GROUP BY 1")
def _a16(d):
    return d.inventory_events().groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


@reg("a17_ewm", f"""
WITH hrs AS (SELECT DISTINCT hour_bucket FROM hourly_cat), cats AS (SELECT DISTINCT category FROM hourly_cat),
dense AS (SELECT h.hour_bucket, c.category, CAST(coalesce(x.purchases, 0) AS DOUBLE) AS x
          FROM hrs h CROSS JOIN cats c LEFT JOIN hourly_cat x ON x.hour_bucket = h.hour_bucket AND x.category = c.category),
idx AS (SELECT category, x, row_number() OVER (PARTITION BY category ORDER BY hour_bucket) - 1 AS i,
               count(*) OVER (PARTITION BY category) AS n FROM dense)
SELECT category, {R('sum(x * CASE WHEN i = 0 THEN pow(0.6, n - 1) ELSE 0.4 * pow(0.6, n - 1 - i) END)', 4)} AS ewm_level
FROM idx GROUP BY category""", {"hourly_cat": f"""
  SELECT date_trunc('hour', c.timestamp) AS hour_bucket, p.category, count(*) AS purchases
  FROM clickstream c JOIN products p ON c.product_id = p.product_id
  WHERE c.{PUR} AND c.product_id IS NOT NULL GROUP BY 1, 2"""})
def _a17(d):
    fc = G.demand_forecast(G.hourly_category_demand(d.clickstream(), d.products()))
    return fc.filter(F.col("step") == 1).select("category", "ewm_level")


@reg("a18_guarded_fold", """
SELECT warehouse_id, CAST(sum(current_stock) AS BIGINT) AS total_stock, count_if(current_stock = 0) AS empty_slots
FROM stock GROUP BY 1""")
def _a18(d):
    return stock_of(d).groupBy("warehouse_id").agg(F.sum("current_stock").cast("bigint").alias("total_stock"),
                                                  F.count_if(F.col("current_stock") == 0).alias("empty_slots"))


@reg("a19_counters_conversion", "SELECT product_id, conversion_rate FROM metrics WHERE total_views > 0")
def _a19(d):
    return metrics_of(d).filter(F.col("total_views") > 0).select("product_id", "conversion_rate")


_A20_SRC = f"SELECT CAST(product_price AS DOUBLE) AS v FROM clickstream WHERE {PUR}"


@reg("a20_histogram", f"""
WITH src AS ({_A20_SRC}), r AS (SELECT min(v) AS lo, max(v) AS hi FROM src),
b AS (SELECT lo, (hi - lo) / 20.0 AS w,
             CASE WHEN (hi - lo) / 20.0 = 0 THEN 0 ELSE CAST(least(floor((v - lo) / ((hi - lo) / 20.0)), 19) AS INTEGER) END AS bin
      FROM src, r WHERE v IS NOT NULL)
SELECT bin, {R('lo + bin * w', 6)} AS bin_start, {R('lo + (bin + 1) * w', 6)} AS bin_end, count(*) AS count
FROM b GROUP BY ALL""")
def _a20(d):
    return histogram(_pur(d), [], "product_price", 20)


@reg("a21_box_summary", f"""
WITH g AS (SELECT device_type, CAST(product_price AS DOUBLE) AS v FROM clickstream WHERE {PUR}),
qs AS (SELECT device_type, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS q2, quantile_cont(v, 0.75) AS q3
       FROM g GROUP BY 1)
SELECT g.device_type, {R('min(v)', 2)} AS min,
       {R('min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))', 2)} AS lower_whisker,
       {R('any_value(q1)', 2)} AS q25, {R('any_value(q2)', 2)} AS q50, {R('any_value(q3)', 2)} AS q75,
       {R('max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))', 2)} AS upper_whisker, {R('max(v)', 2)} AS max,
       count(*) FILTER (WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outliers
FROM g JOIN qs ON g.device_type = qs.device_type GROUP BY g.device_type""")
def _a21(d):
    return box_summary(_pur(d), ["device_type"], "product_price")


@reg("a22_share_of_group", f"""
SELECT device_type, event_type, {R('count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY device_type)', 1)} AS pct
FROM clickstream GROUP BY 1, 2""")
def _a22(d):
    c = d.clickstream().groupBy("device_type", "event_type").agg(F.count(F.lit(1)).alias("n"))
    t = c.groupBy("device_type").agg(F.sum("n").alias("t"))
    return c.join(t, "device_type").select("device_type", "event_type", rnd(F.col("n") * 100.0 / F.col("t"), 1).alias("pct"))


# ---------------------------------------------------------------- W: windows
@reg("w1_share_of_total", f"""
SELECT p.category, {R('count(*) * 100.0 / sum(count(*)) OVER ()', 2)} AS pct_of_purchases
FROM clickstream c JOIN products p ON c.product_id = p.product_id WHERE c.{PUR} GROUP BY 1""")
def _w1(d):
    c = _pur(d).join(d.products().select("product_id", "category"), "product_id").groupBy("category").agg(
        F.count(F.lit(1)).alias("n"))
    tot = c.agg(F.sum("n").alias("t"))
    return c.crossJoin(F.broadcast(tot)).select("category", rnd(F.col("n") * 100.0 / F.col("t"), 2).alias("pct_of_purchases"))


@reg("w2_latest_per_key", """
SELECT user_id, event_id, event_type, timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, event_id DESC) AS rn FROM clickstream)
WHERE rn = 1""")
def _w2(d):
    return latest_by(d.clickstream().select("user_id", "event_id", "event_type", "timestamp"), ["user_id"],
                     ["timestamp", "event_id"])


@reg("w3_rolling_mean", f"""
SELECT category, hour_bucket, purchases,
       {R('avg(purchases) OVER (PARTITION BY category ORDER BY hour_bucket ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 6)} AS ma_3h
FROM (SELECT date_trunc('hour', c.timestamp) AS hour_bucket, p.category, count(*) AS purchases
      FROM clickstream c JOIN products p ON c.product_id = p.product_id WHERE c.{PUR} GROUP BY 1, 2)""")
def _w3(d):
    h = G.hourly_category_demand(d.clickstream(), d.products())
    w = Window.partitionBy("category").orderBy("hour_bucket").rowsBetween(-2, 0)
    return h.withColumn("ma_3h", rnd(F.avg("purchases").over(w), 6))


def _w4_sql():
    from . import oracle_analytics  # noqa: F401
    from .oracle import BODIES
    return (f"SELECT category, ewm_trend FROM ({BODIES['g9_demand_forecast']}) WHERE step = 1",
            {"hourly_cat": oracle_analytics.HOURLY})


@reg("w4_trend_last_steps", *_w4_sql())
def _w4(d):
    fc = G.demand_forecast(G.hourly_category_demand(d.clickstream(), d.products()))
    return fc.filter(F.col("step") == 1).select("category", "ewm_trend")


@reg("w5_quantile_rank", """
SELECT user_id, CASE WHEN N <= 1 THEN 1 ELSE CAST(greatest(1, ceil((r - 1) * least(5, N) / (N - 1.0))) AS INTEGER) END AS M
FROM (SELECT user_id, count(*) OVER () AS N, row_number() OVER (ORDER BY monetary, user_id) AS r
      FROM (SELECT user_id, sum(coalesce(product_price, 0)) AS monetary FROM clickstream WHERE event_type = 'purchase'
            GROUP BY 1))""")
def _w5(d):
    m = _pur(d).groupBy("user_id").agg(F.sum(F.coalesce(F.col("product_price"), F.lit(0))).alias("monetary"))
    return quantile_bins(materialize(m, "monetary"), "monetary", "user_id", "M").select("user_id", "M")


@reg("w6_top_per_user", f"""
SELECT user_id, category FROM (
  SELECT c.user_id, p.category, row_number() OVER (PARTITION BY c.user_id ORDER BY count(*) DESC, p.category) AS rn
  FROM clickstream c JOIN products p ON c.product_id = p.product_id WHERE c.{PUR} GROUP BY 1, 2) WHERE rn = 1""")
def _w6(d):
    per = _pur(d).join(d.products().select("product_id", "category"), "product_id").groupBy("user_id", "category") \
        .agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("user_id").agg(F.min_by("category", F.struct(-F.col("n"), F.col("category"))).alias("category"))


@reg("w7_previous_stage_ratio", "SELECT device_type, stage, " + R(
    "sessions * 100.0 / nullif(lag(sessions) OVER (PARTITION BY device_type ORDER BY stage_order), 0)", 1)
    + " AS step_cvr_pct FROM (" + " UNION ALL ".join(
        f"SELECT device_type, {i + 1} AS stage_order, '{s}' AS stage, {s} AS sessions FROM ({staged('device_type')})"
        for i, s in enumerate(FUNNEL_STAGES)) + ")")
def _w7(d):
    f = stage_sessions(d.clickstream(), ["device_type"])
    rows = [F.struct(F.lit(s).alias("stage"),
                     (F.lit(None).cast("double") if i == 0 else
                      rnd(safe_div(F.col(s) * 100.0, F.col(FUNNEL_STAGES[i - 1])), 1)).alias("step_cvr_pct"))
            for i, s in enumerate(FUNNEL_STAGES)]
    return f.select("device_type", F.inline(F.array(*rows)))


# ---------------------------------------------------------------- L: sorts / limits
@reg("l1_order_by_nulls_last", """
SELECT product_id, CAST(revenue AS DOUBLE) AS revenue FROM metrics
ORDER BY revenue DESC NULLS LAST, product_id""")
def _l1(d):
    return metrics_of(d).orderBy(F.desc_nulls_last("revenue"), "product_id").select(
        "product_id", F.col("revenue").cast("double").alias("revenue"))


@reg("l2_top_k", f"SELECT event_id, timestamp FROM clickstream WHERE {PUR} ORDER BY timestamp DESC, event_id DESC LIMIT 10")
def _l2(d):
    return _pur(d).orderBy(F.desc("timestamp"), F.desc("event_id")).limit(10).select("event_id", "timestamp")


@reg("l3_nlargest", f"""
SELECT p.category, count(*) AS purchases FROM clickstream c JOIN products p ON c.product_id = p.product_id
WHERE c.{PUR} GROUP BY 1 ORDER BY purchases DESC, category LIMIT 3""")
def _l3(d):
    return (_pur(d).join(d.products().select("product_id", "category"), "product_id").groupBy("category")
            .agg(F.count(F.lit(1)).alias("purchases")).orderBy(F.desc("purchases"), "category").limit(3))


@reg("l4_idxmax", f"""
SELECT day, hour FROM (
  SELECT day, hour, row_number() OVER (PARTITION BY day ORDER BY n DESC, hour) AS rn
  FROM (SELECT CAST(timestamp AS DATE) AS day, CAST(hour(timestamp) AS INTEGER) AS hour, count(*) AS n
        FROM clickstream WHERE {PUR} GROUP BY 1, 2)) WHERE rn = 1""")
def _l4(d):
    per = _pur(d).groupBy(F.to_date("timestamp").alias("day"), F.hour("timestamp").cast("int").alias("hour")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("day").agg(F.min_by("hour", F.struct(-F.col("n"), F.col("hour"))).alias("hour"))


@reg("l5_fixed_order", "SELECT event_type, count(*) AS n, CAST(CASE event_type " + " ".join(
    f"WHEN '{t}' THEN {i + 1}" for i, t in enumerate(EVENT_TYPES)) + " END AS INTEGER) AS position FROM clickstream GROUP BY 1")
def _l5(d):
    return d.clickstream().groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "position", in_list_position(F.col("event_type"), EVENT_TYPES).cast("int"))


# ---------------------------------------------------------------- F: scalar functions
@reg("f1_date_trunc", "SELECT event_id, CAST(timestamp AS DATE) AS day, date_trunc('hour', timestamp) AS hour_bucket, "
     "date_trunc('day', timestamp) AS day_bucket FROM clickstream")
def _f1(d):
    return d.clickstream().select("event_id", F.to_date("timestamp").alias("day"),
                                  F.date_trunc("hour", "timestamp").alias("hour_bucket"),
                                  F.date_trunc("day", "timestamp").alias("day_bucket"))


@reg("f2_extract", "SELECT event_id, CAST(hour(timestamp) AS INTEGER) AS hour, CAST(isodow(timestamp) AS INTEGER) AS iso_dow "
     "FROM clickstream")
def _f2(d):
    return d.clickstream().select("event_id", F.hour("timestamp").cast("int").alias("hour"),
                                  iso_dow(F.col("timestamp")).cast("int").alias("iso_dow"))


@reg("f3_epoch_diff", f"""
SELECT session_id, {R('epoch(max(timestamp) - min(timestamp)) / 60.0', 3)} AS minutes,
       {R('epoch(max(timestamp) - min(timestamp)) / 3600.0', 4)} AS hours,
       {R('epoch(max(timestamp) - min(timestamp)) / 86400.0', 6)} AS days FROM clickstream GROUP BY 1""")
def _f3(d):
    s = seconds_between(F.max("timestamp"), F.min("timestamp"))
    return d.clickstream().groupBy("session_id").agg(rnd(s / 60.0, 3).alias("minutes"), rnd(s / 3600.0, 4).alias("hours"),
                                                     rnd(s / 86400.0, 6).alias("days"))


@reg("f4_interval_range", """
SELECT unnest(generate_series(date_trunc('hour', min(timestamp)), date_trunc('hour', max(timestamp)), INTERVAL '1 hour'))
  AS hour FROM clickstream""")
def _f4(d):
    b = d.clickstream().agg(F.date_trunc("hour", F.min("timestamp")).alias("a"),
                            F.date_trunc("hour", F.max("timestamp")).alias("b"))
    return b.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 1 HOUR"))).alias("hour"))


@reg("f5_round", f"""
SELECT event_id, {R('CAST(product_price AS DOUBLE) * 0.99', 2)} AS discounted, {R('CAST(product_price AS DOUBLE) / 3', 1)} AS third
FROM clickstream WHERE product_price IS NOT NULL""")
def _f5(d):
    p = F.col("product_price").cast("double")
    return d.clickstream().filter(F.col("product_price").isNotNull()).select(
        "event_id", rnd(p * 0.99, 2).alias("discounted"), rnd(p / 3, 1).alias("third"))


@reg("f6_abs_clamp", """
SELECT product_id, warehouse_id, src_order, src_line, abs(quantity_change) AS absolute_quantity,
       greatest(quantity_change, 0) AS inbound, least(quantity_change, 0) AS outbound FROM inventory_events""")
def _f6(d):
    q_ = F.col("quantity_change")
    return d.inventory_events().select("product_id", "warehouse_id", "src_order", "src_line",
                                       F.abs(q_).alias("absolute_quantity"), F.greatest(q_, F.lit(0)).alias("inbound"),
                                       F.least(q_, F.lit(0)).alias("outbound"))


@reg("f7_nullif_coalesce", f"""
SELECT product_id, {R('total_purchases / nullif(total_views, 0)', 4)} AS rate, coalesce(last_updated, TIMESTAMP '1970-01-01') AS seen
FROM metrics""")
def _f7(d):
    m = metrics_of(d)
    return m.select("product_id", rnd(safe_div(F.col("total_purchases"), F.col("total_views")), 4).alias("rate"),
                    F.coalesce(F.col("last_updated"), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")).alias("seen"))


@reg("f8_casts", """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, CAST(value AS DECIMAL(10,2)) AS price,
       CAST(user_id AS VARCHAR) AS user_key FROM events""")
def _f8(d):
    ev = d.spark.read.parquet(f"{d.data_dir}/events.parquet")
    return ev.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"),
                     F.col("value").cast("decimal(10,2)").alias("price"), F.col("user_id").cast("string").alias("user_key"))


@reg("f9_title_case", """
SELECT DISTINCT event_type, CASE event_type WHEN 'page_view' THEN 'Page View' WHEN 'product_view' THEN 'Product View'
  WHEN 'add_to_cart' THEN 'Add To Cart' WHEN 'remove_from_cart' THEN 'Remove From Cart' WHEN 'purchase' THEN 'Purchase' END
  AS label FROM clickstream""")
def _f9(d):
    return d.clickstream().select("event_type").distinct().select("event_type", title_words(F.col("event_type")).alias("label"))


@reg("f10_power", f"""
SELECT category, CAST(s.range AS INTEGER) AS step, {R('pow(0.85, s.range)', 6)} AS weight
FROM (SELECT DISTINCT category FROM products) c, range(1, 7) s""")
def _f10(d):
    c = d.products().select("category").distinct()
    return c.select("category", F.explode(F.sequence(F.lit(1), F.lit(6))).alias("step")).withColumn(
        "weight", rnd(F.pow(F.lit(0.85), F.col("step")), 6))


@reg("f11_json_decode", """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def _f11(d):
    ev = d.spark.read.parquet(f"{d.data_dir}/events.parquet")
    return ev.select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


@reg("f12_iso_to_timestamp", "SELECT event_id, timestamp AS parsed FROM clickstream")
def _f12(d):
    iso = F.date_format(F.col("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return d.clickstream().select("event_id", F.to_timestamp(iso, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX")
                                  .cast("timestamp_ntz").alias("parsed"))


# ---------------------------------------------------------------- H: reshape
@reg("h1_melt", f"UNPIVOT ({staged('device_type')}) ON {', '.join(FUNNEL_STAGES)} INTO NAME stage VALUE sessions")
def _h1(d):
    return U.funnel_by_device(d.clickstream()).unpivot("device_type", FUNNEL_STAGES, "stage", "sessions")


@reg("h2_dense_pivot", f"""
WITH hc AS (SELECT date_trunc('hour', c.timestamp) AS hour_bucket, p.category, count(*) AS purchases
            FROM clickstream c JOIN products p ON c.product_id = p.product_id WHERE c.{PUR} GROUP BY 1, 2)
SELECT h.hour_bucket, c.category, coalesce(hc.purchases, 0) AS purchases
FROM (SELECT DISTINCT hour_bucket FROM hc) h CROSS JOIN (SELECT DISTINCT category FROM hc) c
LEFT JOIN hc ON hc.hour_bucket = h.hour_bucket AND hc.category = c.category""")
def _h2(d):
    h = G.hourly_category_demand(d.clickstream(), d.products())
    return densify(h, [h.select("hour_bucket").distinct(), h.select("category").distinct()],
                   ["hour_bucket", "category"], ["purchases"])


@reg("h3_reindex_grid", """
SELECT g.d AS day_of_week, g.h AS hour_of_day, coalesce(c.n, 0) AS page_views
FROM (SELECT CAST(d.range AS INTEGER) AS d, CAST(h.range AS INTEGER) AS h FROM range(1, 8) d, range(0, 24) h) g
LEFT JOIN (SELECT CAST(isodow(timestamp) AS INTEGER) AS d, CAST(hour(timestamp) AS INTEGER) AS h, count(*) AS n
           FROM clickstream WHERE event_type = 'page_view' GROUP BY 1, 2) c ON g.d = c.d AND g.h = c.h""")
def _h3(d):
    c = d.clickstream().filter(F.col("event_type") == "page_view").groupBy(
        iso_dow(F.col("timestamp")).cast("int").alias("day_of_week"), F.hour("timestamp").cast("int").alias("hour_of_day")
    ).agg(F.count(F.lit(1)).alias("page_views"))
    return densify(c, [int_axis(d.spark, "day_of_week", 1, 7), int_axis(d.spark, "hour_of_day", 0, 23)],
                   ["day_of_week", "hour_of_day"], ["page_views"])


@reg("h4_pivot_wide", "SELECT CAST(timestamp AS DATE) AS day, " + ", ".join(
    f"count(*) FILTER (WHERE device_type = '{v}') AS {v}" for v in DEVICES) + f" FROM clickstream WHERE {PUR} GROUP BY 1")
def _h4(d):
    pv = _pur(d).groupBy(F.to_date("timestamp").alias("day")).pivot("device_type", DEVICES).agg(F.count(F.lit(1)))
    return pv.na.fill(0)
