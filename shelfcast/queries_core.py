"""Query registrations for staging, marts, state and pricing."""
from __future__ import annotations

from pyspark.sql import functions as F

from .plans import marts, pricing, staging
from .registry import (COMPETITOR_LOOKBACK, DEMAND_LOOKBACK, metrics_of, recs_of, register,
                       stock_of)


@register("p1_stg_clickstream")
def _p1(d):
    return staging.stg_clickstream(d.clickstream())


@register("p2_stg_inventory")
def _p2(d):
    return staging.stg_inventory(d.inventory_events())


@register("x1_stg_competitor_prices")
def _x1(d):
    return staging.stg_competitor_prices(d.competitor_prices())


@register("x2_hourly_demand")
def _x2(d):
    return marts.hourly_demand(d.clickstream(), d.products())


@register("x3_daily_funnel_metrics")
def _x3(d):
    return marts.daily_funnel_metrics(d.clickstream(), d.products())


@register("x4_pricing_analysis")
def _x4(d):
    return marts.pricing_analysis(d.products(), d.competitor_prices(), recs_of(d),
                                  lookback=COMPETITOR_LOOKBACK)


@register("x5_product_performance")
def _x5(d):
    return marts.product_performance(d.products(), metrics_of(d), stock_of(d))


@register("e1_demand_velocity")
def _e1(d):
    return pricing.demand_velocity(d.clickstream(), lookback=DEMAND_LOOKBACK)


@register("e2_avg_competitor_price")
def _e2(d):
    return pricing.avg_competitor_price(d.competitor_prices())


@register("e4_pricing_cycle")
def _e4(d):
    return recs_of(d)


@register("g12_inventory_state")
def _g12(d):
    return stock_of(d).select("product_id", "warehouse_id", "current_stock")


@register("g13_product_metrics")
def _g13(d):
    return metrics_of(d).withColumn("revenue", F.col("revenue").cast("double"))
