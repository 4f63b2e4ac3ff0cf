"""Oracle SQL for the data-quality rules."""
from __future__ import annotations

from . import oracle_core  # noqa: F401  (fills BODIES)
from .oracle import BODIES, q

EXTRA = {
    "stg_clickstream": BODIES["p1_stg_clickstream"],
    "stg_inventory": BODIES["p2_stg_inventory"],
    "stg_competitor_prices": BODIES["x1_stg_competitor_prices"],
    "daily_funnel_metrics": BODIES["x3_daily_funnel_metrics"],
    "product_performance": BODIES["x5_product_performance"],
    "pricing_analysis": BODIES["x4_pricing_analysis"],
    "hourly_demand": BODIES["x2_hourly_demand"],
}


def rule(group: str, name: str, value_sql: str, comparison: str, expected_sql: str) -> str:
    op, sign = {"eq": ("=", "exactly"), "le": ("<=", "at most"), "ge": (">=", "at least")}[comparison]
    return (f"SELECT '{group}' AS rule_group, '{name}' AS rule_name, v AS value, e AS expected, '{comparison}' AS comparison, "
            f"coalesce(v {op} e, false) AS passed, concat(v, ' against {sign} ', e) AS detail "
            f"FROM (SELECT CAST(({value_sql}) AS BIGINT) AS v, CAST(({expected_sql}) AS BIGINT) AS e)")


EV_TYPES = "('page_view', 'product_view', 'add_to_cart', 'remove_from_cart', 'purchase')"
RULES = [
    ("Inventory", "no_negative_stock", "SELECT count(*) FROM stock WHERE current_stock < 0", "eq", "0"),
    ("Inventory", "inventory_row_count", "SELECT count(*) FROM stock", "eq",
     "SELECT count(*) * 3 FROM products"),
    ("Inventory", "max_stock",
     "SELECT coalesce(max(current_stock), 0) FROM stock", "le", "100000"),
    ("Clickstream", "valid_event_types",
     f"SELECT count(*) FROM clickstream WHERE event_type NOT IN {EV_TYPES}", "eq", "0"),
    ("Clickstream", "no_orphan_events",
     "SELECT count(*) FROM clickstream WHERE product_id IS NOT NULL "
     "AND product_id NOT IN (SELECT product_id FROM products)", "eq", "0"),
    ("Clickstream", "no_future_timestamps",
     "SELECT count(*) FROM clickstream WHERE timestamp > TIMESTAMP '2024-02-01 00:05:00'", "eq", "0"),
    ("Clickstream", "table_not_empty", "SELECT count(*) FROM clickstream", "ge", "1"),
    ("Competitor Prices", "positive_competitor_prices",
     "SELECT count(*) FROM competitor_prices WHERE competitor_price <= 0", "eq", "0"),
    ("Competitor Prices", "price_diff_within_80pct",
     "SELECT count(*) FROM competitor_prices WHERE price_difference_pct < -80 OR price_difference_pct > 80", "eq", "0"),
    ("Competitor Prices", "known_competitors",
     "SELECT count(*) FROM competitor_prices WHERE competitor_name NOT IN ('TechMart', 'GadgetZone', 'ElectroHub')",
     "eq", "0"),
    ("Pricing Recommendations", "valid_recommendations",
     "SELECT count(*) FROM recs WHERE recommendation NOT IN ('raise', 'lower', 'hold')", "eq", "0"),
    ("Pricing Recommendations", "confidence_in_range",
     "SELECT count(*) FROM recs WHERE confidence_score < 0 OR confidence_score > 1", "eq", "0"),
    ("Pricing Recommendations", "no_orphan_recommendations",
     "SELECT count(*) FROM recs WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM products)",
     "eq", "0"),
    ("Constraints", "products.base_price > 0", "SELECT count(*) FROM products WHERE base_price <= 0", "eq", "0"),
    ("Constraints", "pricing_recommendations.recommended_price > 0",
     "SELECT count(*) FROM recs WHERE recommended_price <= 0", "eq", "0"),
    ("Constraints", "pricing_recommendations.confidence_score in [0, 1]",
     "SELECT count_if(confidence_score < 0 OR confidence_score > 1) FROM recs", "eq", "0"),
    *[("Constraints", f"foreign key {named}.product_id",
       f"SELECT count(*) FROM {t} t WHERE NOT EXISTS (FROM products p WHERE p.product_id = t.product_id)", "eq", "0")
      for named, t in [("inventory_state", "stock"), ("inventory_events", "inventory_events"),
                       ("competitor_prices", "competitor_prices")]],
]
NOT_NULL = {
    "stg_clickstream": ["event_id", "user_id", "session_id", "event_type", "device_type", "event_timestamp",
                        "hour_of_day", "day_of_week"],
    "stg_inventory": ["event_id", "product_id", "warehouse_id", "event_type", "quantity_change", "event_timestamp",
                      "absolute_quantity"],
    "stg_competitor_prices": ["product_id", "competitor_name", "competitor_price", "observed_at", "our_price"],
    "daily_funnel_metrics": ["day", "category"],
    "hourly_demand": ["hour_bucket", "category"],
    "product_performance": ["product_id", "product_name", "category"],
    "pricing_analysis": ["product_id", "price_position", "our_price"],
}
for t, cols in NOT_NULL.items():
    for c in cols:
        RULES.append(("Schema", f"not_null {t}.{c}", f"SELECT count(*) FROM {t} WHERE {c} IS NULL", "eq", "0"))
for t, k in [("stg_clickstream", "event_id"), ("stg_inventory", "event_id"), ("product_performance", "product_id"),
             ("pricing_analysis", "product_id")]:
    RULES.append(("Schema", f"unique {t}.{k}",
                  f"SELECT count(*) FROM (SELECT {k} FROM {t} GROUP BY {k} HAVING count(*) > 1)", "eq", "0"))
for t, c, vals, where in [
        ("stg_clickstream", "event_type", EV_TYPES, ""),
        ("stg_clickstream", "device_type", "('mobile', 'desktop', 'tablet')", ""),
        ("stg_inventory", "warehouse_id", "('WH-LAGOS', 'WH-ABUJA', 'WH-PH')", ""),
        ("stg_competitor_prices", "competitor_name", "('TechMart', 'GadgetZone', 'ElectroHub')", ""),
        ("pricing_analysis", "price_position", "('cheaper', 'pricier', 'competitive')", ""),
        ("pricing_analysis", "recommendation", "('raise', 'lower', 'hold')", "")]:
    RULES.append(("Schema", f"accepted_values {t}.{c}",
                  f"SELECT count(*) FROM {t} WHERE {c} IS NOT NULL AND {c} NOT IN {vals}{where}", "eq", "0"))


def report(pred) -> str:
    return "\nUNION ALL\n".join(rule(*r) for r in RULES if pred(r))


for number, name in enumerate((
        "no_negative_stock", "inventory_row_count", "max_stock", "valid_event_types", "no_orphan_events",
        "no_future_timestamps", "table_not_empty", "positive_competitor_prices", "price_diff_within_80pct",
        "known_competitors", "valid_recommendations", "confidence_in_range", "no_orphan_recommendations"), 2):
    q(f"q{number}_{name}", report(lambda r, name=name: r[1] == name), EXTRA)
q("q1_quality_report", report(lambda r: True), EXTRA)
q("q15_not_null", report(lambda r: r[1].startswith("not_null")), EXTRA)
q("q16_unique", report(lambda r: r[1].startswith("unique")), EXTRA)
q("q17_accepted_values", report(lambda r: r[1].startswith("accepted_values")), EXTRA)
q("q18_constraints", report(lambda r: r[0] == "Constraints"), EXTRA)
q("q19_quality_summary", f"""
WITH rep AS ({report(lambda r: True)})
SELECT rule_group, count(*) AS rules, count_if(passed) AS passed, count_if(NOT passed) AS failed
FROM rep GROUP BY rule_group
UNION ALL
SELECT 'ALL', count(*), count_if(passed), count_if(NOT passed) FROM rep""", EXTRA)
