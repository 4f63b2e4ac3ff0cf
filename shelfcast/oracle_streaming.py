"""Oracle SQL for sources/sinks and the streaming jobs (streaming = batch)."""
from __future__ import annotations

from .oracle import q

q("s2_parse_events", "SELECT event_id, user_id, event_type, value FROM events")
q("s4_append_dedup", "SELECT DISTINCT event_id, event_type, timestamp FROM clickstream")
q("s5_upsert", """
SELECT product_id, competitor_name, CAST(competitor_price AS DOUBLE) AS price, timestamp FROM latest_cp""")
q("s7_seed_inventory", """
SELECT p.product_id, w.warehouse_id, CAST(0 AS BIGINT) AS current_stock FROM products p, warehouses w""")
q("s8_read_since", """
SELECT event_id, event_type, timestamp FROM clickstream
WHERE timestamp > (SELECT t FROM ev_as_of) - INTERVAL '7 days'""")
q("s9_export_table", "SELECT event_id, event_type, timestamp, CAST(timestamp AS DATE) AS date FROM clickstream")
q("s10_coerce_for_lake", """
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       CAST(product_id AS VARCHAR) AS product_id, product_price FROM clickstream""")
q("s12_export_all", """
SELECT "table", CASE run WHEN 1 THEN n ELSE 0 END AS exported_rows, cursor, run FROM (
  SELECT 'clickstream_events' AS "table", count(*) AS n, strftime(max(timestamp), '%Y-%m-%d %H:%M:%S.%f') AS cursor FROM clickstream
  UNION ALL SELECT 'inventory_events', count(*), strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') FROM inventory_events
  UNION ALL SELECT 'competitor_prices', count(*), strftime(max(timestamp), '%Y-%m-%d %H:%M:%S') FROM competitor_prices)
CROSS JOIN (VALUES (1), (2)) r(run)""")
q("s7_seed_metrics", """
SELECT product_id, CAST(0 AS BIGINT) AS total_views, CAST(0 AS BIGINT) AS total_cart_adds, CAST(0 AS BIGINT) AS total_purchases,
       CAST(0 AS DOUBLE) AS conversion_rate, CAST(0 AS DOUBLE) AS revenue FROM products""")
q("t2_stream_dedup", "SELECT DISTINCT event_id, event_type, timestamp FROM clickstream")
COUNTERS = """
SELECT product_id,
       count(*) FILTER (WHERE event_type = 'product_view') AS total_views,
       count(*) FILTER (WHERE event_type = 'add_to_cart') AS total_cart_adds,
       count(*) FILTER (WHERE event_type = 'purchase') AS total_purchases,
       CAST(coalesce(sum(coalesce(product_price, 0)) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE) AS revenue
FROM clickstream WHERE product_id IS NOT NULL GROUP BY product_id"""
q("t3_stream_fanout", COUNTERS)
q("t4_stream_product_metrics", COUNTERS)
q("t5_stream_guarded_stock", """
SELECT product_id, warehouse_id,
       CAST(list_reduce(list(quantity_change ORDER BY timestamp, src_order, src_line, quantity_change),
                        lambda s, x: CASE WHEN s + x >= 0 THEN s + x ELSE s END, 0) AS BIGINT) AS current_stock
FROM inventory_events GROUP BY product_id, warehouse_id""")
q("t6_stream_competitor_latest", """
SELECT product_id, competitor_name, CAST(competitor_price AS DOUBLE) AS competitor_price, timestamp AS observed_at
FROM latest_cp""")
q("t7_stream_pricing", "SELECT * FROM recs")
q("t7_pricing_from_state", "SELECT * FROM recs")
q("t8_stream_throughput", """
SELECT time_bucket(INTERVAL '1 hour', timestamp) AS window_start,
       time_bucket(INTERVAL '1 hour', timestamp) + INTERVAL '1 hour' AS window_end,
       count(*) AS events, count(*) / 3600.0 AS events_per_sec
FROM clickstream GROUP BY 1
HAVING time_bucket(INTERVAL '1 hour', timestamp) + INTERVAL '1 hour' <= (SELECT t FROM ev_as_of) - INTERVAL '1 hour'""")
ALL_STREAMS = " UNION ALL ".join(f"SELECT '{t}' AS s, timestamp FROM {v}" for t, v in (
    ("clickstream_events", "clickstream"), ("inventory_events", "inventory_events"), ("competitor_prices", "competitor_prices")))
# One watermark for the union: the newest time of all, less the delay.
q("t8_throughput_by_stream", f"""
SELECT s AS stream, date_trunc('day', timestamp)::TIMESTAMP AS window_start,
       date_trunc('day', timestamp)::TIMESTAMP + INTERVAL '1 day' AS window_end, count(*) AS events, count(*) / 86400.0 AS events_per_sec
FROM ({ALL_STREAMS}) GROUP BY 1, 2, 3
HAVING date_trunc('day', timestamp)::TIMESTAMP + INTERVAL '1 day' <=
       (SELECT max(timestamp) FROM ({ALL_STREAMS})) - INTERVAL '1 day'""")
q("t10_lake_archive_all", f"""
SELECT s AS "table", CAST(timestamp AS DATE) AS date, count(*) AS n_rows FROM ({ALL_STREAMS}) GROUP BY ALL""")
q("t10_stream_lake_archive", "SELECT event_id, event_type, CAST(timestamp AS DATE) AS date FROM clickstream")

# The skipped-change log re-derived with a recursive walk over each key's
# ordered events (independent of the vectorised fold).
q("t11_skipped_stock_changes", """
WITH RECURSIVE ev AS (
  SELECT *, row_number() OVER (PARTITION BY product_id, warehouse_id
                               ORDER BY timestamp, src_order, src_line, quantity_change) AS rn
  FROM inventory_events),
walk(product_id, warehouse_id, rn, stock, applied) AS (
  SELECT product_id, warehouse_id, rn, greatest(quantity_change, 0), quantity_change >= 0 FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.product_id, e.warehouse_id, e.rn,
         CASE WHEN w.stock + e.quantity_change >= 0 THEN w.stock + e.quantity_change ELSE w.stock END,
         w.stock + e.quantity_change >= 0
  FROM walk w JOIN ev e ON e.product_id = w.product_id AND e.warehouse_id = w.warehouse_id AND e.rn = w.rn + 1)
SELECT e.product_id, e.warehouse_id, e.quantity_change, e.timestamp, e.src_order, e.src_line,
       'would produce negative stock' AS reason
FROM walk w JOIN ev e ON e.product_id = w.product_id AND e.warehouse_id = w.warehouse_id AND e.rn = w.rn
WHERE NOT w.applied""")
