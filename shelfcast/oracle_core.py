"""Oracle SQL for staging, marts, state and pricing."""
from __future__ import annotations

from .oracle import R, q, staged

q("p1_stg_clickstream", """
SELECT event_id, user_id, session_id, event_type, product_id, product_price, device_type,
       timestamp AS event_timestamp, CAST(hour(timestamp) AS INTEGER) AS hour_of_day,
       CAST(isodow(timestamp) AS INTEGER) AS day_of_week
FROM clickstream""")

q("p2_stg_inventory", """
SELECT event_id, product_id, warehouse_id, event_type, quantity_change, abs(quantity_change) AS absolute_quantity,
       timestamp AS event_timestamp
FROM inventory_events""")

q("x1_stg_competitor_prices", """
SELECT product_id, competitor_name, competitor_price, our_price, price_difference, price_difference_pct,
       timestamp AS observed_at
FROM latest_cp""")

q("x2_hourly_demand", """
WITH counted AS (
  SELECT product_id, date_trunc('hour', timestamp) AS hour_bucket, event_type, count(*) AS n
  FROM clickstream WHERE event_type NOT IN ('page_view', 'remove_from_cart') GROUP BY ALL)
SELECT hour_bucket, category,
       CAST(sum(if(event_type = 'purchase', n, 0)) AS BIGINT) AS purchases,
       CAST(sum(if(event_type = 'product_view', n, 0)) AS BIGINT) AS product_views,
       CAST(sum(if(event_type = 'add_to_cart', n, 0)) AS BIGINT) AS cart_adds
FROM counted JOIN products USING (product_id)
GROUP BY hour_bucket, category""")

q("x3_daily_funnel_metrics", f"""
WITH labelled AS (
  SELECT CAST(timestamp AS DATE) AS day, event_type, session_id,
         coalesce((SELECT category FROM products p WHERE p.product_id = c.product_id), 'unknown') AS category
  FROM clickstream c)
SELECT *, {R('100 * (purchases / nullif(page_views, 0))', 2)} AS conversion_rate
FROM ({staged('day, category', 'labelled', names=('page_views', 'product_views', 'cart_adds', 'purchases'))})""")

q("x4_pricing_analysis", f"""
WITH by_competitor AS (
  SELECT product_id, competitor_name, count(*) AS n, sum(competitor_price) AS total,
         min(competitor_price) AS low, max(competitor_price) AS high
  FROM competitor_prices WHERE timestamp > (SELECT t - INTERVAL '365 days' FROM cp_as_of)
  GROUP BY ALL),
market AS (
  SELECT product_id, {R('CAST(sum(total) AS DOUBLE) / CAST(sum(n) AS DOUBLE)', 2)} AS avg_competitor_price,
         CAST(min(low) AS DOUBLE) AS min_competitor_price, CAST(max(high) AS DOUBLE) AS max_competitor_price,
         count(competitor_name) AS competitor_count
  FROM by_competitor GROUP BY product_id),
ours AS (SELECT product_id, product_name, category, CAST(base_price AS DOUBLE) AS our_price FROM products),
advice AS (SELECT product_id, recommendation, confidence_score, recommended_price, timestamp AS rec_timestamp FROM recs)
SELECT product_id, product_name, category, our_price,
       avg_competitor_price, min_competitor_price, max_competitor_price, competitor_count,
       coalesce(if(our_price < min_competitor_price * 0.95, 'cheaper', NULL),
                if(our_price > max_competitor_price * 1.05, 'pricier', NULL), 'competitive') AS price_position,
       recommendation, confidence_score, recommended_price, rec_timestamp
FROM ours LEFT JOIN market USING (product_id) LEFT JOIN advice USING (product_id)""")

# counters and stock have a row (or a row a warehouse) for every product
q("x5_product_performance", f"""
WITH held AS (
  SELECT product_id, CAST(sum(current_stock) AS BIGINT) AS total_stock_all_warehouses FROM stock GROUP BY product_id),
sold AS (
  SELECT product_id, total_views, total_cart_adds, total_purchases, conversion_rate, last_updated,
         CAST(revenue AS DOUBLE) AS total_revenue,
         {R('CAST(revenue AS DOUBLE) / nullif(total_purchases, 0)', 2)} AS avg_sale_price
  FROM metrics)
SELECT * REPLACE (CAST(base_price AS DOUBLE) AS base_price)
FROM products JOIN sold USING (product_id) JOIN held USING (product_id)""")

q("e1_demand_velocity", "SELECT * FROM demand")

q("e2_avg_competitor_price", "SELECT * FROM comp_avg")

q("e4_pricing_cycle", "SELECT * FROM recs")

q("g12_inventory_state", "SELECT * FROM stock")

q("g13_product_metrics", """
SELECT product_id, total_views, total_cart_adds, total_purchases, conversion_rate,
       CAST(revenue AS DOUBLE) AS revenue, last_updated
FROM metrics""")
