"""Dashboard queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import LOW_STOCK, WAREHOUSES, rnd, safe_div, stock_band
from .elasticity import latest_recs


def overview_kpis(metrics: DataFrame, products: DataFrame) -> DataFrame:
    """Product count, revenue, purchases, mean conversion of viewed products."""
    n = products.agg(F.count(F.lit(1)).alias("total_products"))
    m = metrics.agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        F.coalesce(F.sum("total_purchases"), F.lit(0)).cast("bigint").alias("total_purchases"),
        rnd(F.coalesce(F.avg(F.when(F.col("total_views") > 0, F.col("conversion_rate"))) * 100.0, F.lit(0.0)), 6)
        .alias("avg_conversion_rate"))
    return n.crossJoin(m)


def top_products_by_revenue(metrics: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    """B2/L2: top-k products by revenue (ties: product_id)."""
    j = (metrics.filter(F.col("revenue") > 0).select("product_id", "revenue")
                .orderBy(F.desc("revenue"), "product_id").limit(k)
                .join(products.select("product_id", "product_name"), "product_id"))
    return j.select("product_id", "product_name", F.col("revenue").cast("double").alias("revenue"))


def latest_recommendations(recs: DataFrame, k: int = 10) -> DataFrame:
    """The k most recent recommendations (ties: product_id)."""
    return (recs.orderBy(F.desc("timestamp"), "product_id").limit(k)
                .select("product_id", "product_name", "recommendation", "confidence_score",
                        "recommended_price", "timestamp"))


def inventory_kpis(stock: DataFrame) -> DataFrame:
    """Total stock, products below 20 in total, products at 0."""
    per = stock.groupBy("product_id").agg(F.sum("current_stock").alias("total"))
    return per.agg(F.coalesce(F.sum("total"), F.lit(0)).cast("bigint").alias("total_stock"),
                   F.count_if(F.col("total") < LOW_STOCK).alias("low_stock_alerts"),
                   F.count_if(F.col("total") == 0).alias("out_of_stock"))


def stock_by_warehouse(products: DataFrame, stock: DataFrame) -> DataFrame:
    """Stock pivoted by warehouse (explicit list), 0 filled, with Total."""
    pv = stock.groupBy("product_id").pivot("warehouse_id", WAREHOUSES).agg(F.max("current_stock"))
    j = products.select("product_id", "product_name", "category").join(pv, "product_id", "left")
    cols = [F.coalesce(F.col(f"`{w}`"), F.lit(0)).cast("bigint").alias(w) for w in WAREHOUSES]
    out = j.select("product_id", "product_name", "category", *cols)
    return out.withColumn("Total", sum((F.col(f"`{w}`") for w in WAREHOUSES), F.lit(0)).cast("bigint"))


def stock_bands(wide: DataFrame) -> DataFrame:
    """Band label per stock cell (red < 10, amber < 30, green)."""
    cells = [*WAREHOUSES, "Total"]
    return wide.select("product_id", *[stock_band(F.col(f"`{c}`")).alias(f"{c}_band") for c in cells])


def stock_by_category(products: DataFrame, stock: DataFrame) -> DataFrame:
    """Total stock per category."""
    per = stock.groupBy("product_id").agg(F.sum("current_stock").alias("s"))
    return (per.join(products.select("product_id", "category"), "product_id")
               .groupBy("category").agg(F.sum("s").cast("bigint").alias("total_stock")))


def recommendation_kpis(recs: DataFrame) -> DataFrame:
    """Raise / lower / hold counts of the latest recommendations."""
    r = F.col("recommendation")
    return latest_recs(recs).agg(F.count_if(r == "raise").alias("to_raise"),
                                 F.count_if(r == "lower").alias("to_lower"),
                                 F.count_if(r == "hold").alias("on_hold"))


def all_latest_recommendations(recs: DataFrame) -> DataFrame:
    """Every product's latest recommendation."""
    return latest_recs(recs).select("product_id", "product_name", "current_price", "avg_competitor_price",
                                    "demand_velocity", "recommendation", "confidence_score",
                                    "recommended_price", "timestamp")


def price_vs_velocity(recs: DataFrame) -> DataFrame:
    """Price difference pct vs demand velocity per product."""
    r = latest_recs(recs)
    pct = safe_div(F.col("current_price") - F.col("avg_competitor_price"), F.col("avg_competitor_price")) * 100.0
    return r.select("product_id", "product_name", rnd(pct, 2).alias("price_difference_pct"),
                    "demand_velocity", "recommendation")


def latest_events(ev: DataFrame, products: DataFrame, k: int = 50) -> DataFrame:
    """The k newest events with product name (limit first, then join)."""
    top = ev.orderBy(F.desc("timestamp"), F.desc("event_id")).limit(k)
    return (top.join(products.select("product_id", "product_name"), "product_id", "left")
               .select("event_id", "event_type", "product_name", "device_type", "timestamp"))


def event_type_counts(ev: DataFrame) -> DataFrame:
    """Events per type."""
    return ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def device_counts(ev: DataFrame) -> DataFrame:
    """Events per device."""
    return ev.groupBy("device_type").agg(F.count(F.lit(1)).alias("count"))
