"""Oracle SQL for funnel, RFM, demand, elasticity and dashboard analytics."""
from __future__ import annotations

from .oracle import R, q, staged

STAGES = [("page_view", "Page View"), ("product_view", "Product View"),
          ("add_to_cart", "Add to Cart"), ("purchase", "Purchase")]


def or1(x: str) -> str:
    return f"(CASE WHEN {x} = 0 THEN 1 ELSE {x} END)"


def hist(src: str, groups: list[str], value: str, n: int) -> str:
    g = ", ".join(groups)
    gsel = (g + ", ") if groups else ""
    join = (" JOIN r USING (" + g + ")") if groups else ", r"
    return f"""
WITH src AS ({src}),
r AS (SELECT {gsel}min(CAST({value} AS DOUBLE)) AS lo, max(CAST({value} AS DOUBLE)) AS hi FROM src GROUP BY ALL),
b AS (SELECT {gsel}lo, hi, (hi - lo) / {float(n)} AS w,
             CASE WHEN (hi - lo) / {float(n)} = 0 THEN 0
                  ELSE CAST(least(floor((CAST({value} AS DOUBLE) - lo) / ((hi - lo) / {float(n)})), {n - 1}) AS INTEGER)
             END AS bin
      FROM src{join} WHERE {value} IS NOT NULL)
SELECT {gsel}bin, {R('lo + bin * w', 6)} AS bin_start, {R('lo + (bin + 1) * w', 6)} AS bin_end, count(*) AS count
FROM b GROUP BY ALL"""


def describe(src: str, groups: list[str], value: str) -> str:
    gsel = (", ".join(groups) + ", ") if groups else ""
    v = f"CAST({value} AS DOUBLE)"
    return f"""
SELECT {gsel}count({v}) AS count, {R(f'avg({v})', 2)} AS mean, {R(f'stddev_samp({v})', 2)} AS std,
       {R(f'min({v})', 2)} AS min, {R(f'quantile_cont({v}, 0.25)', 2)} AS q25,
       {R(f'quantile_cont({v}, 0.5)', 2)} AS q50, {R(f'quantile_cont({v}, 0.75)', 2)} AS q75,
       {R(f'max({v})', 2)} AS max
FROM ({src}) GROUP BY ALL"""


# ---------------------------------------------------------------- funnel
q("u1_clickstream_overview", """
WITH users AS (SELECT DISTINCT user_id FROM clickstream), visits AS (SELECT DISTINCT session_id FROM clickstream),
times AS (SELECT count(*) AS n, min(timestamp) AS a, max(timestamp) AS b FROM clickstream)
SELECT n AS total_events, (SELECT count(user_id) FROM users) AS unique_users,
       (SELECT count(session_id) FROM visits) AS unique_sessions, CAST(a AS DATE) AS earliest_date,
       CAST(b AS DATE) AS latest_date, (epoch_us(b) - epoch_us(a)) / 1e6 AS data_span_seconds
FROM times""")

q("u2_event_distribution", f"""
WITH visits AS (SELECT event_type, session_id, count(*) AS n FROM clickstream GROUP BY ALL),
total AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM clickstream)
SELECT event_type, CAST(sum(v.n) AS BIGINT) AS event_count, count(session_id) AS sessions,
       {R('100 * CAST(sum(v.n) AS DOUBLE) / any_value(total.n)', 1)} AS pct_of_events
FROM visits v, total GROUP BY event_type""")

_funnel_rows = []
for i, (s, label) in enumerate(STAGES):
    step = "100.0" if i == 0 else R(f"{s} / {or1(STAGES[i - 1][0])} * 100.0", 1)
    _funnel_rows.append(f"SELECT {i + 1} AS stage_order, '{label}' AS stage, {s} AS sessions, "
                        f"{R(f'{s} / {or1(STAGES[0][0])} * 100.0', 1)} AS overall_cvr_pct, {step} AS step_cvr_pct FROM sc")
q("u3_funnel", f"WITH sc AS ({staged('')})\n" + "\nUNION ALL\n".join(_funnel_rows),
  )

q("u4_funnel_summary", f"""
SELECT {R(f"add_to_cart / {or1('product_view')} * 100.0", 1)} AS product_view_to_cart_pct,
       {R(f"purchase / {or1('add_to_cart')} * 100.0", 1)} AS cart_to_purchase_pct,
       {R(f"purchase / {or1('page_view')} * 100.0", 2)} AS overall_conversion_pct
FROM ({staged('')})""")

_by_device = staged("device_type")
q("u5_funnel_by_device", f"""
SELECT device_type, page_view, product_view, add_to_cart, purchase,
       {R('product_view / nullif(page_view, 0) * 100.0', 1)} AS product_view_cvr,
       {R('add_to_cart / nullif(page_view, 0) * 100.0', 1)} AS add_to_cart_cvr,
       {R('purchase / nullif(page_view, 0) * 100.0', 1)} AS purchase_cvr
FROM ({_by_device})""")

q("u5_best_device", f"""
SELECT device_type, {R('purchase / nullif(page_view, 0) * 100.0', 1)} AS purchase_cvr
FROM ({_by_device}) WHERE page_view > 0
ORDER BY purchase_cvr DESC, device_type LIMIT 1""")

_by_cat = staged("category", "(SELECT * FROM clickstream JOIN products USING (product_id))",
                 ("product_view", "add_to_cart", "purchase"))
q("u6_funnel_by_category", f"""
SELECT *, {R('purchase / nullif(product_view, 0) * 100.0', 1)} AS purchase_cvr FROM ({_by_cat})""")
q("u6_funnel_long", f"""
WITH f AS ({_by_cat})
SELECT category, 'Product View' AS stage, product_view AS sessions FROM f
UNION ALL SELECT category, 'Add To Cart', add_to_cart FROM f
UNION ALL SELECT category, 'Purchase', purchase FROM f""")

q("u7_hourly_activity", """
SELECT CAST(hour(timestamp) AS INTEGER) AS hour, event_type, count(*) AS event_count
FROM clickstream GROUP BY 1, 2""")
q("u7_peak_purchase_hours", """
SELECT CAST(hour(timestamp) AS INTEGER) AS hour, count(*) AS event_count
FROM clickstream WHERE event_type = 'purchase' GROUP BY 1 ORDER BY event_count DESC, hour LIMIT 3""")

_sessions = f"""
SELECT session_id, device_type, CAST(sum(n) AS BIGINT) AS event_count, count(event_type) AS distinct_event_types,
       min(a) AS session_start, max(b) AS session_end,
       {R('(epoch_us(max(b)) - epoch_us(min(a))) / 6e7', 2)} AS duration_min, max(event_type = 'purchase') AS converted
FROM (SELECT session_id, device_type, event_type, count(*) AS n, min(timestamp) AS a, max(timestamp) AS b
      FROM clickstream GROUP BY ALL)
GROUP BY session_id, device_type"""
q("u8_sessions", _sessions)
q("u9_session_totals", f"""
SELECT count(*) AS total_sessions, count_if(converted) AS converted_sessions,
       {R('count_if(converted) / nullif(count(*), 0) * 100.0', 2)} AS conversion_rate_pct,
       {R('avg(event_count)', 2)} AS avg_events, {R('avg(duration_min)', 2)} AS avg_duration_min
FROM ({_sessions})""")
q("u10_session_outcome_summary", f"""
SELECT CASE WHEN converted THEN 'Converted' ELSE 'Not Converted' END AS outcome, count(*) AS sessions,
       {R('avg(event_count)', 2)} AS avg_events, {R('avg(duration_min)', 2)} AS avg_duration_min,
       {R('avg(distinct_event_types)', 2)} AS avg_distinct_types
FROM ({_sessions}) GROUP BY 1""")
q("u11_session_cvr_by_device", f"""
SELECT device_type, count(*) AS total, count_if(converted) AS converted,
       {R('count_if(converted) / count(*) * 100.0', 1)} AS cvr
FROM ({_sessions}) GROUP BY device_type""")
q("u12_session_event_histogram", hist(
    f"SELECT CASE WHEN converted THEN 'Converted' ELSE 'Not Converted' END AS outcome, event_count FROM ({_sessions})",
    ["outcome"], "event_count", 25))

# ---------------------------------------------------------------- RFM
q("r1_purchase_overview", f"""
WITH visits AS (
  SELECT user_id, session_id, count(*) AS n, sum(coalesce(product_price, 0)) AS spent,
         min(timestamp) AS a, max(timestamp) AS b
  FROM clickstream WHERE event_type = 'purchase' GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_purchase_events,
       (SELECT count(*) FROM (SELECT user_id FROM visits GROUP BY user_id)) AS unique_buyers,
       (SELECT count(*) FROM (SELECT session_id FROM visits GROUP BY session_id)) AS unique_purchase_sessions,
       CAST(min(a) AS DATE) AS first_purchase, CAST(max(b) AS DATE) AS last_purchase,
       {R('CAST(sum(spent) AS DOUBLE) / CAST(sum(n) AS DOUBLE)', 2)} AS avg_order_value,
       {R('sum(spent)', 2)} AS total_gmv
FROM visits""")
q("r2_purchases_per_user", """
SELECT purchases, count(*) AS user_count FROM (
  SELECT user_id, count(*) AS purchases FROM clickstream WHERE event_type = 'purchase' GROUP BY user_id)
GROUP BY purchases""")
q("r2_purchase_histogram", hist(
    "SELECT user_id, count(*) AS purchase_count FROM clickstream WHERE event_type = 'purchase' GROUP BY user_id",
    [], "purchase_count", 30))

RAW = f"""
SELECT user_id, count(*) AS frequency, {R('sum(coalesce(product_price, 0))', 2)} AS monetary,
       {R('epoch((SELECT t FROM ev_as_of) - max(timestamp)) / 86400.0', 1)} AS recency_days
FROM clickstream WHERE event_type = 'purchase' GROUP BY user_id HAVING count(*) > 0"""
q("r3_rfm_raw", RAW)
q("r3_rfm_describe", "\nUNION ALL\n".join(
    describe(f"SELECT '{m}' AS measure, {m} FROM rfm_raw", ["measure"], m) for m in
    ["recency_days", "frequency", "monetary"]), {"rfm_raw": RAW})


def _qbin(col: str, desc_labels: bool) -> str:
    lab = ("CASE WHEN N <= 1 THEN 1 ELSE CAST(greatest(1, ceil((r_{c} - 1) * least(5, N) / (N - 1.0))) AS INTEGER) END"
           .replace("{c}", col))
    return f"(least(5, N) + 1 - {lab})" if desc_labels else lab


SCORES = f"""
SELECT user_id, frequency, monetary, recency_days,
       CAST({_qbin('rec', True)} AS INTEGER) AS R, CAST({_qbin('freq', False)} AS INTEGER) AS F,
       CAST({_qbin('mon', False)} AS INTEGER) AS M
FROM (SELECT *, count(*) OVER () AS N,
             row_number() OVER (ORDER BY recency_days, user_id) AS r_rec,
             row_number() OVER (ORDER BY frequency, user_id) AS r_freq,
             row_number() OVER (ORDER BY monetary, user_id) AS r_mon
      FROM rfm_raw)"""
SEGMENTED = """
SELECT *, R + F + M AS RFM_sum,
       CASE WHEN R >= 4 AND F >= 4 AND M >= 4 THEN 'Champions'
            WHEN R >= 3 AND F >= 4 THEN 'Loyal Customers'
            WHEN R >= 4 AND F <= 2 THEN 'Potential Loyalists'
            WHEN M >= 4 AND F <= 2 THEN 'Big Spenders'
            WHEN R <= 2 AND F >= 3 THEN 'At Risk'
            WHEN R = 1 THEN 'Lost'
            ELSE 'Needs Attention' END AS segment
FROM rfm_q"""
RFM_CTES = {"rfm_raw": RAW, "rfm_q": SCORES, "rfm": SEGMENTED}
q("r4_rfm_scores", "SELECT * FROM rfm", RFM_CTES)
q("r5_rfm_segment", "SELECT user_id, R, F, M, segment FROM rfm", RFM_CTES)
q("r6_rf_matrix", "SELECT R, " + ", ".join(f"count(*) FILTER (WHERE F = {i}) AS F{i}" for i in range(1, 6))
  + " FROM rfm GROUP BY R", RFM_CTES)
q("r7_segment_sizes", """
SELECT segment, count(*) AS users,
       CAST(CASE segment WHEN 'Champions' THEN 1 WHEN 'Loyal Customers' THEN 2 WHEN 'Potential Loyalists' THEN 3
            WHEN 'Big Spenders' THEN 4 WHEN 'At Risk' THEN 5 WHEN 'Lost' THEN 6 WHEN 'Needs Attention' THEN 7 END
            AS INTEGER) AS segment_order
FROM rfm GROUP BY segment""", RFM_CTES)
q("r8_segment_revenue", f"SELECT segment, {R('sum(monetary)', 2)} AS total_spend FROM rfm GROUP BY segment",
  RFM_CTES)
q("r9_segment_profiles", f"""
SELECT segment, count(*) AS users, {R('avg(recency_days)', 2)} AS avg_recency_days,
       {R('avg(frequency)', 2)} AS avg_frequency, {R('avg(monetary)', 2)} AS avg_monetary,
       {R('sum(monetary)', 2)} AS total_spend, {R('avg(R)', 2)} AS avg_R_score,
       {R('avg(F)', 2)} AS avg_F_score, {R('avg(M)', 2)} AS avg_M_score
FROM rfm GROUP BY segment""", RFM_CTES)
PREF = """
SELECT p.user_id, p.device_type, r.segment FROM (
  SELECT user_id, device_type,
         row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, device_type) AS rn
  FROM clickstream WHERE event_type = 'purchase' GROUP BY user_id, device_type) p
JOIN rfm r ON p.user_id = r.user_id WHERE p.rn = 1"""
PREF_CTES = {**RFM_CTES, "pref": PREF}
q("r10_preferred_device", "SELECT * FROM pref", PREF_CTES)
q("r10_device_by_segment", "SELECT segment, device_type, count(*) AS users FROM pref GROUP BY 1, 2", PREF_CTES)
q("r11_device_share", f"""
SELECT segment,
       coalesce(max(pct) FILTER (WHERE device_type = 'mobile'), 0.0) AS mobile,
       coalesce(max(pct) FILTER (WHERE device_type = 'desktop'), 0.0) AS desktop,
       coalesce(max(pct) FILTER (WHERE device_type = 'tablet'), 0.0) AS tablet
FROM (SELECT segment, device_type, {R('users / sum(users) OVER (PARTITION BY segment) * 100.0', 1)} AS pct
      FROM (SELECT segment, device_type, count(*) AS users FROM pref GROUP BY 1, 2))
GROUP BY segment""", PREF_CTES)

# ---------------------------------------------------------------- demand
q("g1_demand_overview", f"""
WITH bought AS (
  SELECT user_id, product_id, count(*) AS n, min(timestamp) AS a, max(timestamp) AS b
  FROM clickstream WHERE event_type = 'purchase' GROUP BY ALL)
SELECT CAST(sum(n) AS BIGINT) AS total_purchases,
       (SELECT count(*) FROM (SELECT user_id FROM bought GROUP BY user_id)) AS unique_buyers,
       (SELECT count(product_id) FROM (SELECT product_id FROM bought GROUP BY product_id)) AS distinct_products_bought,
       min(a) AS first_purchase, max(b) AS last_purchase,
       {R('CAST(sum(n) AS DOUBLE) / nullif((epoch_us(max(b)) - epoch_us(min(a))) / 3.6e9, 0)', 2)} AS purchases_per_hour
FROM bought""")
q("g2_daily_purchases", """
SELECT CAST(timestamp AS DATE) AS day, count(*) AS purchases FROM clickstream
WHERE event_type = 'purchase' GROUP BY 1""")
HOURLY = """
SELECT date_trunc('hour', c.timestamp) AS hour_bucket, p.category, count(*) AS purchases
FROM clickstream c JOIN products p ON c.product_id = p.product_id
WHERE c.event_type = 'purchase' AND c.product_id IS NOT NULL GROUP BY 1, 2"""
HC = {"hourly_cat": HOURLY}
q("g3_hourly_category_demand", "SELECT * FROM hourly_cat", HC)
q("g4_category_totals", f"""
SELECT category, sum(purchases) AS total, {R('avg(purchases)', 2)} AS avg_per_hour,
       {R('stddev_samp(purchases)', 2)} AS std_per_hour FROM hourly_cat GROUP BY category""", HC)
HT = """
SELECT date_trunc('hour', timestamp) AS hour_bucket, count(*) AS purchases FROM clickstream
WHERE event_type = 'purchase' GROUP BY 1"""
q("g5_moving_averages", f"""
SELECT hour_bucket, purchases,
       {R('avg(purchases) OVER (ORDER BY hour_bucket ROWS BETWEEN CURRENT ROW AND CURRENT ROW)', 6)} AS ma_1h,
       {R('avg(purchases) OVER (ORDER BY hour_bucket ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 6)} AS ma_3h
FROM ({HT})""")
q("g5_series_stats", f"""
SELECT {R('avg(purchases)', 2)} AS mean_per_hour, {R('stddev_samp(purchases)', 2)} AS std_per_hour,
       max(purchases) AS peak_hour_count, min(purchases) AS lowest_hour_count FROM ({HT})""")
HEAT = """
SELECT g.d AS day_of_week,
       ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][g.d] AS day_name,
       g.h AS hour_of_day, CAST(coalesce(c.n, 0) AS BIGINT) AS purchases
FROM (SELECT CAST(d.range AS INTEGER) AS d, CAST(h.range AS INTEGER) AS h FROM range(1, 8) d, range(0, 24) h) g
LEFT JOIN (SELECT CAST(isodow(timestamp) AS INTEGER) AS d, CAST(hour(timestamp) AS INTEGER) AS h, count(*) AS n
           FROM clickstream WHERE event_type = 'purchase' GROUP BY 1, 2) c
ON g.d = c.d AND g.h = c.h"""
q("g6_demand_heatmap", HEAT)
q("g6_heatmap_wide", "SELECT day_of_week, day_name, " + ", ".join(
    f'max(purchases) FILTER (WHERE hour_of_day = {h}) AS "{h}"' for h in range(24))
  + f" FROM ({HEAT}) GROUP BY 1, 2")
q("g7_peak_slots", f"""
SELECT * FROM ({HEAT}) WHERE purchases > 0
ORDER BY purchases DESC, day_of_week, hour_of_day LIMIT 5""")
q("g8_category_ranking", f"""
SELECT category, sum(purchases) AS total_purchases, {R('avg(purchases)', 2)} AS avg_per_hour,
       {R('stddev_samp(purchases)', 2)} AS std_per_hour, count(purchases) AS hours_with_sales,
       {R('stddev_samp(purchases) / nullif(avg(purchases), 0)', 2)} AS cv
FROM hourly_cat GROUP BY category""", HC)
q("g9_demand_forecast", f"""
WITH hrs AS (SELECT DISTINCT hour_bucket FROM hourly_cat),
cats AS (SELECT DISTINCT category FROM hourly_cat),
dense AS (SELECT h.hour_bucket, c.category, CAST(coalesce(x.purchases, 0) AS DOUBLE) AS x
          FROM hrs h CROSS JOIN cats c
          LEFT JOIN hourly_cat x ON x.hour_bucket = h.hour_bucket AND x.category = c.category),
idx AS (SELECT category, hour_bucket, x,
               row_number() OVER (PARTITION BY category ORDER BY hour_bucket) - 1 AS i FROM dense),
ends AS (SELECT category, count(*) AS n, max(hour_bucket) AS last_hour FROM idx GROUP BY category),
tg AS (SELECT category, n - 1 AS t, 'end' AS which FROM ends
       UNION ALL SELECT category, n - 1 - least(4, n - 1), 'back' FROM ends WHERE n > 1),
ys AS (SELECT tg.category, tg.which,
              sum(idx.x * CASE WHEN idx.i = 0 THEN pow(0.6, tg.t) ELSE 0.4 * pow(0.6, tg.t - idx.i) END) AS y
       FROM tg JOIN idx ON idx.category = tg.category AND idx.i <= tg.t GROUP BY tg.category, tg.which),
st AS (SELECT e.category, e.last_hour, ye.y AS level,
              CASE WHEN e.n > 1 THEN (ye.y - yb.y) / least(4, e.n - 1) END AS trend
       FROM ends e JOIN ys ye ON ye.category = e.category AND ye.which = 'end'
       LEFT JOIN ys yb ON yb.category = e.category AND yb.which = 'back')
SELECT last_hour + CAST(s.range AS INTEGER) * INTERVAL '1 hour' AS hour, category, CAST(s.range AS INTEGER) AS step,
       {R('CASE WHEN trend IS NULL THEN 0.0 ELSE greatest(0.0, level + trend * s.range * pow(0.85, s.range)) END', 2)}
         AS forecast_purchases,
       {R('level', 4)} AS ewm_level, {R('trend', 4)} AS ewm_trend
FROM st, range(1, 7) s""", HC)
SR = f"""
SELECT i.product_id, p.product_name, p.category, CAST(i.total_stock AS BIGINT) AS total_stock,
       coalesce(d.rate, 0.0) AS purchases_per_hour
FROM (SELECT product_id, sum(current_stock) AS total_stock FROM stock GROUP BY product_id) i
JOIN products p ON i.product_id = p.product_id
LEFT JOIN (SELECT product_id,
                  {R('count(*) / nullif(epoch(max(timestamp) - min(timestamp)) / 3600.0, 0)', 4)} AS rate
           FROM clickstream WHERE event_type = 'purchase' AND product_id IS NOT NULL GROUP BY product_id) d
ON i.product_id = d.product_id"""
HORIZON = f"""
SELECT *, CASE WHEN hours_until_stockout IS NULL THEN 'No Demand'
               WHEN hours_until_stockout = 0 THEN 'Out of Stock'
               WHEN hours_until_stockout < 3000 THEN 'Critical (<3000h)'
               WHEN hours_until_stockout < 9000 THEN 'Warning (<9000h)'
               ELSE 'Healthy' END AS status
FROM (SELECT *, {R('total_stock / nullif(purchases_per_hour, 0)', 1)} AS hours_until_stockout FROM sr)"""
HZ = {"sr": SR, "horizon": HORIZON}
q("g10_stock_and_rate", "SELECT * FROM sr", HZ)
q("g11_stockout_horizon", "SELECT * FROM horizon", HZ)
q("g11_at_risk", "SELECT * FROM horizon WHERE status NOT IN ('No Demand', 'Healthy')", HZ)
q("g11_status_counts", "SELECT status, count(*) AS products FROM horizon GROUP BY status", HZ)

# ---------------------------------------------------------------- elasticity
q("k1_price_overview", """
SELECT (SELECT count(DISTINCT product_id) FROM competitor_prices) AS products_tracked,
       (SELECT count(DISTINCT competitor_name) FROM competitor_prices) AS competitors,
       (SELECT count(*) FROM competitor_prices) AS total_price_obs,
       (SELECT CAST(min(timestamp) AS DATE) FROM competitor_prices) AS earliest_obs,
       (SELECT CAST(max(timestamp) AS DATE) FROM competitor_prices) AS latest_obs,
       (SELECT count(DISTINCT product_id) FROM recs) AS products_with_rec,
       (SELECT count(*) FROM recs) AS total_recs""")
LR = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY timestamp DESC) AS rn
                            FROM recs) WHERE rn = 1"""
LRC = {"latest_recs": LR}
PCT = "(current_price - avg_competitor_price) / nullif(avg_competitor_price, 0) * 100.0"
q("k2_category_price_position", f"""
SELECT p.category, {R('avg(r.current_price)', 2)} AS avg_our_price,
       {R('avg(r.avg_competitor_price)', 2)} AS avg_comp_price,
       {R(f'avg({PCT})', 1)} AS avg_pct_above_comp, count(DISTINCT r.product_id) AS products
FROM latest_recs r JOIN products p ON r.product_id = p.product_id GROUP BY p.category""", LRC)
POS = f"""
SELECT r.product_id, r.product_name, p.category, r.current_price, r.avg_competitor_price, r.recommendation,
       {R(PCT, 1)} AS pct_vs_competitor
FROM latest_recs r JOIN products p ON r.product_id = p.product_id"""
q("k3_price_position", POS, LRC)
q("k4_above_below_par", f"""
SELECT count_if(pct_vs_competitor > 0) AS above, count_if(pct_vs_competitor < 0) AS below,
       count_if(pct_vs_competitor = 0) AS at_par FROM ({POS})""", LRC)
GAPS = f"""
SELECT c.product_id, p.product_name, p.category, c.competitor_name,
       {R('(CAST(c.our_price AS DOUBLE) - CAST(c.competitor_price AS DOUBLE)) / nullif(CAST(c.competitor_price AS DOUBLE), 0) * 100.0', 2)}
         AS pct_above_competitor
FROM competitor_prices c JOIN products p ON c.product_id = p.product_id"""
GC = {"gaps": GAPS}
q("k5_price_gaps", "SELECT * FROM gaps", GC)
q("k5_gap_describe", describe("SELECT * FROM gaps", ["competitor_name"], "pct_above_competitor"), GC)
q("k5_gap_histogram", hist("SELECT * FROM gaps", ["category"], "pct_above_competitor", 40), GC)
q("k5_gap_box", f"""
WITH qs AS (SELECT competitor_name, quantile_cont(pct_above_competitor, 0.25) AS q1,
                   quantile_cont(pct_above_competitor, 0.5) AS q2, quantile_cont(pct_above_competitor, 0.75) AS q3
            FROM gaps GROUP BY competitor_name)
SELECT g.competitor_name, {R('min(pct_above_competitor)', 2)} AS min,
       {R('min(pct_above_competitor) FILTER (WHERE pct_above_competitor >= q1 - 1.5 * (q3 - q1))', 2)} AS lower_whisker,
       {R('any_value(q1)', 2)} AS q25, {R('any_value(q2)', 2)} AS q50, {R('any_value(q3)', 2)} AS q75,
       {R('max(pct_above_competitor) FILTER (WHERE pct_above_competitor <= q3 + 1.5 * (q3 - q1))', 2)} AS upper_whisker,
       {R('max(pct_above_competitor)', 2)} AS max,
       count(*) FILTER (WHERE pct_above_competitor < q1 - 1.5 * (q3 - q1) OR pct_above_competitor > q3 + 1.5 * (q3 - q1))
         AS outliers
FROM gaps g JOIN qs ON g.competitor_name = qs.competitor_name GROUP BY g.competitor_name""", GC)
q("k6_recommendation_table", f"""
SELECT product_id, product_name, current_price, avg_competitor_price, recommendation,
       {R('confidence_score * 100.0', 1)} AS confidence_pct, recommended_price,
       {R('(recommended_price - current_price) / nullif(current_price, 0) * 100.0', 1)} AS price_change_pct, timestamp
FROM latest_recs""", LRC)
q("k7_recommendation_split", "SELECT recommendation, count(*) AS count FROM latest_recs GROUP BY 1", LRC)
LAND = f"""
SELECT c.competitor_name, p.product_name, p.category, count(*) AS observations,
       CAST(sum(CASE WHEN c.competitor_price < c.our_price THEN 1 ELSE 0 END) AS BIGINT) AS times_cheaper,
       {R('sum(CASE WHEN c.competitor_price < c.our_price THEN 1 ELSE 0 END) * 100.0 / nullif(count(*), 0)', 0)}
         AS pct_cheaper
FROM competitor_prices c JOIN products p ON c.product_id = p.product_id
GROUP BY c.competitor_name, p.product_name, p.category"""
LC = {"land": LAND}
q("k8_competitor_landscape", "SELECT * FROM land", LC)
q("k9_undercut_summary", f"""
SELECT competitor_name, sum(times_cheaper) AS times_cheaper, sum(observations) AS observations,
       {R('sum(times_cheaper) / sum(observations) * 100.0', 1)} AS pct_cheaper
FROM land GROUP BY competitor_name""", LC)
for _by, _key in [("product_name", "product"), ("category", "category")]:
    q(f"k10_undercut_matrix_{_key}", f"SELECT {_by}, " + ", ".join(
        f"{R(f'coalesce(avg(pct_cheaper) FILTER (WHERE competitor_name = ' + chr(39) + c + chr(39) + '), 0.0)', 1)} AS {c}"
        for c in ["TechMart", "GadgetZone", "ElectroHub"]) + f" FROM land GROUP BY {_by}", LC)
SIM = f"""
WITH lo AS (SELECT * EXCLUDE (rn) FROM (
              SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY timestamp DESC) AS rn
              FROM recs WHERE recommendation = 'lower') WHERE rn = 1),
b AS (SELECT lo.product_id, lo.product_name, p.category, lo.current_price, lo.recommended_price, m.total_purchases,
             {R('(lo.recommended_price - lo.current_price) / nullif(lo.current_price, 0) * 100.0', 2)} AS price_chg_pct
      FROM lo JOIN products p ON lo.product_id = p.product_id JOIN metrics m ON lo.product_id = m.product_id),
c AS (SELECT *, {R('price_chg_pct * -1.5', 2)} AS demand_chg_pct FROM b),
d AS (SELECT *, {R('greatest(0.0, total_purchases * (1 + demand_chg_pct / 100.0))', 0)} AS proj_purchases,
             {R('current_price * total_purchases', 2)} AS current_rev FROM c),
e AS (SELECT *, {R('recommended_price * proj_purchases', 2)} AS proj_rev FROM d),
f AS (SELECT *, {R('proj_rev - current_rev', 2)} AS rev_delta FROM e)
SELECT *, {R('rev_delta / nullif(current_rev, 0) * 100.0', 1)} AS rev_delta_pct FROM f"""
q("k11_revenue_simulation", SIM)
q("k11_simulation_total", f"SELECT {R('sum(rev_delta)', 2)} AS total_rev_delta, count(*) AS products FROM ({SIM})")

# ---------------------------------------------------------------- dashboard
q("b1_overview_kpis", f"""
SELECT (SELECT count(*) FROM products) AS total_products,
       CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue,
       CAST(coalesce(sum(total_purchases), 0) AS BIGINT) AS total_purchases,
       {R('coalesce(avg(conversion_rate) FILTER (WHERE total_views > 0) * 100.0, 0.0)', 6)} AS avg_conversion_rate
FROM metrics""")
q("b2_top_products_by_revenue", """
SELECT m.product_id, p.product_name, CAST(m.revenue AS DOUBLE) AS revenue
FROM metrics m JOIN products p ON m.product_id = p.product_id WHERE m.revenue > 0
ORDER BY m.revenue DESC, m.product_id LIMIT 10""")
q("b3_latest_recommendations", """
SELECT product_id, product_name, recommendation, confidence_score, recommended_price, timestamp
FROM recs ORDER BY timestamp DESC, product_id LIMIT 10""")
q("b4_inventory_kpis", """
SELECT CAST(coalesce(sum(total), 0) AS BIGINT) AS total_stock, count_if(total < 20) AS low_stock_alerts,
       count_if(total = 0) AS out_of_stock
FROM (SELECT product_id, sum(current_stock) AS total FROM stock GROUP BY product_id)""")
WIDE = """
SELECT p.product_id, p.product_name, p.category,
       CAST(coalesce(max(s.current_stock) FILTER (WHERE s.warehouse_id = 'WH-LAGOS'), 0) AS BIGINT) AS "WH-LAGOS",
       CAST(coalesce(max(s.current_stock) FILTER (WHERE s.warehouse_id = 'WH-ABUJA'), 0) AS BIGINT) AS "WH-ABUJA",
       CAST(coalesce(max(s.current_stock) FILTER (WHERE s.warehouse_id = 'WH-PH'), 0) AS BIGINT) AS "WH-PH"
FROM products p LEFT JOIN stock s ON p.product_id = s.product_id
GROUP BY p.product_id, p.product_name, p.category"""
q("b5_stock_by_warehouse", f'SELECT *, CAST("WH-LAGOS" + "WH-ABUJA" + "WH-PH" AS BIGINT) AS "Total" FROM ({WIDE})')


def _band(c: str) -> str:
    return f"CASE WHEN {c} < 10 THEN 'red' WHEN {c} < 30 THEN 'amber' ELSE 'green' END"


q("b6_stock_band", f"""
SELECT product_id, {_band('"WH-LAGOS"')} AS "WH-LAGOS_band", {_band('"WH-ABUJA"')} AS "WH-ABUJA_band",
       {_band('"WH-PH"')} AS "WH-PH_band", {_band('("WH-LAGOS" + "WH-ABUJA" + "WH-PH")')} AS "Total_band"
FROM ({WIDE})""")
q("b7_stock_by_category", """
SELECT p.category, CAST(sum(s.current_stock) AS BIGINT) AS total_stock
FROM stock s JOIN products p ON s.product_id = p.product_id GROUP BY p.category""")
q("b8_recommendation_kpis", """
SELECT count_if(recommendation = 'raise') AS to_raise, count_if(recommendation = 'lower') AS to_lower,
       count_if(recommendation = 'hold') AS on_hold FROM latest_recs""", LRC)
q("b9_all_latest_recommendations", """
SELECT product_id, product_name, current_price, avg_competitor_price, demand_velocity, recommendation,
       confidence_score, recommended_price, timestamp FROM latest_recs""", LRC)
q("b10_price_vs_velocity", f"""
SELECT product_id, product_name, {R(PCT, 2)} AS price_difference_pct, demand_velocity, recommendation
FROM latest_recs""", LRC)
q("b11_latest_events", """
SELECT c.event_id, c.event_type, p.product_name, c.device_type, c.timestamp
FROM (SELECT * FROM clickstream ORDER BY timestamp DESC, event_id DESC LIMIT 50) c
LEFT JOIN products p ON c.product_id = p.product_id""")
q("b12_event_type_counts", "SELECT event_type, count(*) AS count FROM clickstream GROUP BY 1")
q("b12_device_counts", "SELECT device_type, count(*) AS count FROM clickstream GROUP BY 1")
