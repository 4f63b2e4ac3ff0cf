"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each statement sees only the raw test tables (pre-registered as views) and
inlines the fixture mapping as CTEs. Where the Spark side uses a helper
(max_by, the distributed rank, the streamed fold, the EWM accumulator), the SQL
uses a different formulation (row_number, window counts, list_reduce, a
closed-form weighted sum) so the two are genuinely independent.
"""
from __future__ import annotations


def R(expr: str, n: int) -> str:
    """Half-up rounding after normalising to 6 decimals, as double (= functions.rnd)."""
    return f"CAST(round(CAST(({expr}) AS DECIMAL(38,6)), {n}) AS DOUBLE)"


def staged(keys: str, src: str = "clickstream", stages=("page_view", "product_view", "add_to_cart", "purchase"),
           names=None) -> str:
    """Sessions per funnel stage: distinct (keys, stage, session) rows, counted and laid out sideways."""
    cols = ", ".join(f"count(session_id) FILTER (event_type = '{s}') AS {n}" for s, n in zip(stages, names or stages))
    k = f"{keys}, " if keys else ""
    return (f"SELECT {k}{cols} FROM (SELECT DISTINCT {k}event_type, session_id FROM {src})"
            + (f" GROUP BY {keys}" if keys else ""))


# Fixture mapping (same definitions as shelfcast.sources.fixtures).
BASE_CTES = {
    "products": """
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(10,2)) AS base_price
  FROM part""",
    "clickstream": """
  SELECT event_id, user_id,
         CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
         CASE event_type WHEN 'signup' THEN 'page_view' WHEN 'view' THEN 'product_view'
              WHEN 'click' THEN 'add_to_cart' WHEN 'error' THEN 'remove_from_cart'
              WHEN 'purchase' THEN 'purchase' END AS event_type,
         CASE WHEN event_type <> 'signup' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
         CASE WHEN event_type <> 'signup' THEN CAST(value AS DECIMAL(10,2)) END AS product_price,
         CASE WHEN (user_id * 3 + day(ts)) % 20 < 11 THEN 'mobile'
              WHEN (user_id * 3 + day(ts)) % 20 < 18 THEN 'desktop' ELSE 'tablet' END AS device_type,
         ts AS timestamp
  FROM events""",
    "comp_hist": """
  SELECT l.l_partkey AS product_id,
         CASE l.l_suppkey % 3 WHEN 0 THEN 'TechMart' WHEN 1 THEN 'GadgetZone' ELSE 'ElectroHub' END AS competitor_name,
         CAST(round(CAST(p.p_retailprice AS DECIMAL(12,2))
                    * (CAST(0.8 AS DECIMAL(2,1)) + 4 * CAST(l.l_discount AS DECIMAL(4,2))), 2) AS DECIMAL(10,2))
           AS competitor_price,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS our_price,
         l.l_shipdate AS timestamp, l.l_orderkey AS src_order, l.l_linenumber AS src_line
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey""",
    "competitor_prices": """
  SELECT product_id, competitor_name, competitor_price, our_price,
         CAST(competitor_price - our_price AS DECIMAL(10,2)) AS price_difference,
         CAST(round(CAST(CAST(competitor_price - our_price AS DOUBLE) / CAST(our_price AS DOUBLE) * 100
                         AS DECIMAL(38,6)), 2) AS DECIMAL(6,2)) AS price_difference_pct,
         timestamp, src_order, src_line
  FROM comp_hist""",
    "inventory_events": """
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey || '-' || CAST(l_shipdate AS DATE) AS event_id,
         l_partkey AS product_id,
         CASE l_suppkey % 3 WHEN 0 THEN 'WH-LAGOS' WHEN 1 THEN 'WH-ABUJA' ELSE 'WH-PH' END AS warehouse_id,
         CASE WHEN l_returnflag = 'A' THEN 'stock_received' WHEN l_returnflag = 'R' THEN 'stock_returned'
              WHEN l_linestatus = 'O' THEN 'stock_damaged' ELSE 'manual_adjustment' END AS event_type,
         CAST(CASE WHEN l_returnflag IN ('A', 'R') THEN l_quantity WHEN l_linestatus = 'O' THEN -l_quantity
                   WHEN l_linenumber % 2 = 0 THEN l_quantity ELSE -l_quantity END AS INTEGER) AS quantity_change,
         l_shipdate AS timestamp, l_orderkey AS src_order, l_linenumber AS src_line
  FROM lineitem""",
    "warehouses": """
  SELECT * FROM (VALUES ('WH-LAGOS'), ('WH-ABUJA'), ('WH-PH')) w(warehouse_id)""",
    "ev_as_of": """
  SELECT max(timestamp) AS t FROM clickstream""",
    "cp_as_of": """
  SELECT max(timestamp) AS t FROM competitor_prices""",
}

# Derived domain tables used by several oracles.
DERIVED_CTES = {
    "latest_cp": """
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id, competitor_name
                                 ORDER BY timestamp DESC, src_order DESC, src_line DESC, competitor_price DESC) AS rn
    FROM competitor_prices) WHERE rn = 1""",
    "demand": """
  SELECT c.product_id, CAST(count(*) AS DOUBLE) AS demand_velocity
  FROM clickstream c, ev_as_of a
  WHERE c.event_type = 'purchase' AND c.product_id IS NOT NULL AND c.timestamp > a.t - INTERVAL '7 days'
  GROUP BY c.product_id""",
    "comp_avg": f"""
  SELECT product_id, {R('avg(CAST(competitor_price AS DOUBLE))', 2)} AS avg_competitor_price
  FROM latest_cp GROUP BY product_id""",
    "rec_base": """
  SELECT p.product_id, p.product_name, CAST(p.base_price AS DOUBLE) AS current_price, c.avg_competitor_price,
         coalesce(d.demand_velocity, 0.0) AS demand_velocity,
         (CAST(p.base_price AS DOUBLE) - c.avg_competitor_price) / c.avg_competitor_price * 100 AS gap,
         ((CAST(p.base_price AS DOUBLE) - c.avg_competitor_price) / c.avg_competitor_price * 100 > 10
            AND coalesce(d.demand_velocity, 0.0) < 2) AS is_lower,
         ((CAST(p.base_price AS DOUBLE) - c.avg_competitor_price) / c.avg_competitor_price * 100 < -10
            AND coalesce(d.demand_velocity, 0.0) >= 5) AS is_raise
  FROM products p JOIN comp_avg c ON p.product_id = c.product_id
  LEFT JOIN demand d ON p.product_id = d.product_id""",
    "recs": f"""
  SELECT product_id, product_name, current_price, avg_competitor_price, demand_velocity,
         CASE WHEN is_lower THEN 'lower' WHEN is_raise THEN 'raise' ELSE 'hold' END AS recommendation,
         CASE WHEN is_lower OR is_raise THEN {R('least(abs(gap) / 20.0, 1.0)', 3)}
              ELSE {R('greatest(0.5, 1.0 - abs(gap) / 20.0)', 3)} END AS confidence_score,
         CASE WHEN is_lower OR is_raise THEN {R('avg_competitor_price * 0.99', 2)}
              ELSE current_price END AS recommended_price,
         (SELECT t FROM ev_as_of) AS timestamp
  FROM rec_base""",
    "metrics": f"""
  SELECT p.product_id,
         CAST(coalesce(m.v, 0) AS BIGINT) AS total_views,
         CAST(coalesce(m.c, 0) AS BIGINT) AS total_cart_adds,
         CAST(coalesce(m.b, 0) AS BIGINT) AS total_purchases,
         CASE WHEN coalesce(m.v, 0) > 0 THEN {R('CAST(m.b AS DOUBLE) / m.v', 4)} ELSE 0.0 END AS conversion_rate,
         CAST(coalesce(m.rev, 0) AS DECIMAL(14,2)) AS revenue,
         m.last_updated
  FROM products p LEFT JOIN (
    SELECT product_id,
           count(*) FILTER (WHERE event_type = 'product_view') AS v,
           count(*) FILTER (WHERE event_type = 'add_to_cart') AS c,
           count(*) FILTER (WHERE event_type = 'purchase') AS b,
           sum(coalesce(product_price, 0)) FILTER (WHERE event_type = 'purchase') AS rev,
           max(timestamp) FILTER (WHERE event_type IN ('product_view', 'add_to_cart', 'purchase')) AS last_updated
    FROM clickstream WHERE product_id IS NOT NULL GROUP BY product_id) m
  ON p.product_id = m.product_id""",
    "stock": """
  SELECT s.product_id, s.warehouse_id, CAST(coalesce(f.stock, 0) AS BIGINT) AS current_stock
  FROM (SELECT product_id, warehouse_id FROM products, warehouses) s
  LEFT JOIN (
    SELECT product_id, warehouse_id,
           list_reduce(list(quantity_change ORDER BY timestamp, src_order, src_line, quantity_change),
                       lambda s, x: CASE WHEN s + x >= 0 THEN s + x ELSE s END, 0) AS stock
    FROM inventory_events GROUP BY product_id, warehouse_id) f
  ON s.product_id = f.product_id AND s.warehouse_id = f.warehouse_id""",
}

_ORDER = list(BASE_CTES) + list(DERIVED_CTES)
_ALL = {**BASE_CTES, **DERIVED_CTES}


def with_ctes(body: str, extra: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with every fixture CTE it (transitively) references."""
    import re
    defs = dict(_ALL)
    order = list(_ORDER)
    for k, v in (extra or {}).items():
        defs[k] = v
        order.append(k)
    needed: set[str] = set()

    def visit(text: str):
        for name in order:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                visit(defs[name])
    visit(body)
    parts = [f"{n} AS ({defs[n]}\n)" for n in order if n in needed]
    if not parts:
        return body
    head = body.lstrip()
    if head[:15].upper() == "WITH RECURSIVE ":
        return "WITH RECURSIVE " + ",\n".join(parts) + ",\n" + head[15:]
    if head[:5].upper() == "WITH ":  # merge the body's own CTE list into ours
        return "WITH " + ",\n".join(parts) + ",\n" + head[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body


QUERIES: dict[str, str] = {}
BODIES: dict[str, str] = {}


def q(key: str, body: str, extra: dict[str, str] | None = None) -> None:
    BODIES[key] = body
    QUERIES[key] = with_ctes(body, extra)


def all_queries() -> dict[str, str]:
    from . import oracle_analytics, oracle_core, oracle_quality, oracle_streaming  # noqa: F401
    from . import registry  # noqa: F401  (primitive queries register their SQL with their code)
    return dict(QUERIES)
