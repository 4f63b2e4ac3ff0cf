"""Mart tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import price_position, rnd, safe_div
from ..operators.funnel import count_flags, stage_flags
from ..operators.latest import latest_by
from ..operators.lookup import lookup
from .common import within_lookback

DEMAND_TYPES = ["purchase", "product_view", "add_to_cart"]


def hourly_demand(ev: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases, product views and cart adds per (hour, category).

    Events are first reduced to (hour, product) counts (partial aggregation
    absorbs hot products), so the join with the catalogue sees at most
    hours x products rows instead of every event.
    """
    t = F.col("event_type")
    per_product = (ev.filter(t.isin(*DEMAND_TYPES) & F.col("product_id").isNotNull())
                   .groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket"), "product_id")
                   .agg(F.count_if(t == "purchase").alias("purchases"),
                        F.count_if(t == "product_view").alias("product_views"),
                        F.count_if(t == "add_to_cart").alias("cart_adds")))
    j = per_product.join(products.select("product_id", "category"), "product_id")
    return j.groupBy("hour_bucket", "category").agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ["purchases", "product_views", "cart_adds"]])


def daily_funnel_metrics(ev: DataFrame, products: DataFrame) -> DataFrame:
    """Distinct sessions per stage per (day, category or 'unknown');
    conversion = purchases / page_views * 100 (NULL without page views).

    Events are read once and first reduced to (day, product, session) stage flags. Rows
    without a product (every page view) meet no product in the left join and are spread
    over its tasks by their session. The rows are then reduced per (day, category, session)
    and summed. Rows without a session keep their group alive and reach no stage.
    """
    names = ["page_views", "product_views", "cart_adds", "purchases"]
    flags = stage_flags(ev.withColumn("day", F.to_date("timestamp")), ["day", "product_id"], names=names)
    linked = lookup(flags, products.select("product_id", "category"), "product_id", ["session_id", "day"])
    cols = ["day", F.coalesce("category", F.lit("unknown")).alias("category"), "session_id", *names]
    f = count_flags(linked.select(*cols), ["day", "category"], names)
    return f.withColumn("conversion_rate", rnd(safe_div(F.col("purchases"), F.col("page_views")) * 100, 2))


def product_performance(products: DataFrame, metrics: DataFrame, stock: DataFrame) -> DataFrame:
    """Counters, revenue, average sale price, conversion and total stock per
    product (stock pre-aggregated per product before the join)."""
    inv = stock.groupBy("product_id").agg(F.sum("current_stock").alias("total_stock"))
    j = (products.join(metrics, "product_id", "left").join(inv, "product_id", "left"))
    return j.select(
        "product_id", "product_name", "category",
        F.col("base_price").cast("double").alias("base_price"),
        F.coalesce(F.col("total_views"), F.lit(0)).cast("bigint").alias("total_views"),
        F.coalesce(F.col("total_cart_adds"), F.lit(0)).cast("bigint").alias("total_cart_adds"),
        F.coalesce(F.col("total_purchases"), F.lit(0)).cast("bigint").alias("total_purchases"),
        F.coalesce(F.col("revenue"), F.lit(0)).cast("double").alias("total_revenue"),
        rnd(safe_div(F.col("revenue"), F.col("total_purchases")), 2).alias("avg_sale_price"),
        F.coalesce(F.col("conversion_rate"), F.lit(0.0)).cast("double").alias("conversion_rate"),
        F.coalesce(F.col("total_stock"), F.lit(0)).cast("bigint").alias("total_stock_all_warehouses"),
        "last_updated",
    )


def pricing_analysis(products: DataFrame, cp: DataFrame, recs: DataFrame, as_of=None,
                     lookback: str = "24 hours") -> DataFrame:
    """Our price against recent competitor prices, with the latest
    recommendation; price_position cheaper / pricier / competitive."""
    recent = within_lookback(cp, lookback, as_of)
    comp = recent.groupBy("product_id").agg(
        rnd(F.avg(F.col("competitor_price").cast("double")), 2).alias("avg_competitor_price"),
        F.min("competitor_price").cast("double").alias("min_competitor_price"),
        F.max("competitor_price").cast("double").alias("max_competitor_price"),
        F.count_distinct("competitor_name").cast("bigint").alias("competitor_count"))
    latest = latest_by(recs.select("product_id", "recommendation", "confidence_score", "recommended_price",
                                   F.col("timestamp").alias("rec_timestamp")),
                       ["product_id"], ["rec_timestamp"])
    j = products.join(comp, "product_id", "left").join(latest, "product_id", "left")
    return j.select(
        "product_id", "product_name", "category",
        F.col("base_price").cast("double").alias("our_price"),
        "avg_competitor_price", "min_competitor_price", "max_competitor_price", "competitor_count",
        price_position(F.col("base_price"), F.col("min_competitor_price"), F.col("max_competitor_price"))
        .alias("price_position"),
        "recommendation", "confidence_score", "recommended_price", "rec_timestamp",
    )
