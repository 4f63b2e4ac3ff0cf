"""Query registrations for the data-quality rules (Q1-Q19)."""
from __future__ import annotations

from functools import cache

from pyspark.sql import functions as F

from .operators.latest import latest_by
from .plans import marts, quality, staging
from .plans.common import as_of_col
from .registry import COMPETITOR_LOOKBACK, QUALITY_AS_OF, metrics_of, recs_of, register, stock_of
from .session import materialize


def _tables(d):
    """The stock, the latest prices, the recommendations and the marts of products are read
    by several rules and marts: they are written once for a report."""
    stock = cache(lambda: materialize(stock_of(d), "quality-stock"))
    latest = cache(lambda: materialize(latest_by(d.competitor_prices(), ["product_id", "competitor_name"], staging.COMPETITOR_ORDER),
                                       "quality-latest"))
    recs = cache(lambda: materialize(recs_of(d, latest()), "quality-recs"))
    performance = cache(lambda: materialize(marts.product_performance(d.products(), metrics_of(d), stock()), "quality-performance"))
    pricing = cache(lambda: materialize(marts.pricing_analysis(
        d.products(), d.competitor_prices(), recs(), lookback=COMPETITOR_LOOKBACK), "quality-pricing"))
    return quality.quality_tables(
        d.products, stock, d.clickstream, d.inventory_events, d.competitor_prices, recs,
        staging.stg_clickstream, staging.stg_inventory, lambda _: staging.typed_prices(latest()),
        lambda: marts.daily_funnel_metrics(d.clickstream(), d.products()), performance, pricing,
        lambda: marts.hourly_demand(d.clickstream(), d.products()))


def _rules(d):
    products, ev = d.products(), d.clickstream()
    return quality.default_rules(lambda: products.agg(F.count(F.lit(1))).scalar(),
                                 as_of=lambda: as_of_col(ev, QUALITY_AS_OF))


def _report(d, pick=None):
    rules = _rules(d)
    if pick is not None:
        rules = [r for r in rules if pick(r)]
    return quality.run_rules(_tables(d), rules)


RULE_KEYS = ["q2_no_negative_stock", "q3_inventory_row_count", "q4_max_stock", "q5_valid_event_types", "q6_no_orphan_events",
             "q7_no_future_timestamps", "q8_table_not_empty", "q9_positive_competitor_prices", "q10_price_diff_within_80pct",
             "q11_known_competitors", "q12_valid_recommendations", "q13_confidence_in_range", "q14_no_orphan_recommendations"]

for _k in RULE_KEYS:  # a rule's name follows the number in its key
    register(_k)(lambda d, _name=_k.split("_", 1)[1]: _report(d, lambda r: r.name == _name))

register("q1_quality_report")(lambda d: _report(d))
register("q15_not_null")(lambda d: _report(d, lambda r: r.name.startswith("not_null")))
register("q16_unique")(lambda d: _report(d, lambda r: r.name.startswith("unique")))
register("q17_accepted_values")(lambda d: _report(d, lambda r: r.name.startswith("accepted_values")))
register("q18_constraints")(lambda d: _report(d, lambda r: r.group == "Constraints"))
register("q19_quality_summary")(lambda d: quality.summarize(_report(d)))
