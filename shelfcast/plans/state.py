"""Keyed state tables rebuilt from the event logs.

The reference mutates these row by row as events arrive; here each is an
aggregate over the deduplicated event log, and the streaming jobs maintain the
same result incrementally.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import WAREHOUSES, rnd
from ..operators.fold import guarded_fold, skipped_changes

INVENTORY_ORDER = ["timestamp", "src_order", "src_line", "quantity_change"]


def seed_inventory(products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Every product x warehouse with stock 0 (warehouses: fixed 3-row list)."""
    return (products.select("product_id")
            .crossJoin(F.broadcast(warehouses.select("warehouse_id")))
            .withColumn("current_stock", F.lit(0).cast("bigint")))


def seed_metrics(products: DataFrame) -> DataFrame:
    """One zeroed counter row per product."""
    z = F.lit(0).cast("bigint")
    return products.select("product_id", z.alias("total_views"), z.alias("total_cart_adds"),
                           z.alias("total_purchases"), F.lit(0.0).alias("conversion_rate"),
                           F.lit(0).cast("decimal(14,2)").alias("revenue"))


def product_event_counts(ev: DataFrame, dedup: bool = False) -> DataFrame:
    """Per product: views, cart adds, purchases, revenue, last event time.

    The event log is unique on event_id by construction (ingest deduplicates,
    T2 / S4), so no extra shuffle is spent here unless ``dedup`` asks for it
    (raw feeds that may repeat messages). Page views (no product) are
    filtered before the aggregation.
    """
    e = ev.filter(F.col("product_id").isNotNull())
    if dedup:
        e = e.dropDuplicates(["event_id"])
    t = F.col("event_type")
    return e.groupBy("product_id").agg(
        F.count_if(t == "product_view").cast("bigint").alias("total_views"),
        F.count_if(t == "add_to_cart").cast("bigint").alias("total_cart_adds"),
        F.count_if(t == "purchase").cast("bigint").alias("total_purchases"),
        F.sum(F.when(t == "purchase", F.coalesce(F.col("product_price"), F.lit(0)))).alias("_rev"),
        F.max(F.when(t.isin("product_view", "add_to_cart", "purchase"), F.col("timestamp"))).alias("last_updated"),
    )


def product_metrics(ev: DataFrame, products: DataFrame, dedup: bool = False) -> DataFrame:
    """Counters per catalogue product; conversion = purchases / views
    rounded to 4 places (0 when there are no views)."""
    c = product_event_counts(ev, dedup)
    j = products.select("product_id").join(c, "product_id", "left")
    views = F.coalesce(F.col("total_views"), F.lit(0))
    purch = F.coalesce(F.col("total_purchases"), F.lit(0))
    return j.select(
        "product_id",
        views.cast("bigint").alias("total_views"),
        F.coalesce(F.col("total_cart_adds"), F.lit(0)).cast("bigint").alias("total_cart_adds"),
        purch.cast("bigint").alias("total_purchases"),
        F.when(views > 0, rnd(purch / views, 4)).otherwise(F.lit(0.0)).alias("conversion_rate"),
        F.coalesce(F.col("_rev"), F.lit(0)).cast("decimal(14,2)").alias("revenue"),
        "last_updated",
    )


def inventory_state(inv: DataFrame, products: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Guarded stock per seeded (product, warehouse); a change is applied
    only when the stock stays >= 0, in (timestamp, tie-break) order."""
    folded = guarded_fold(inv, ["product_id", "warehouse_id"], INVENTORY_ORDER, "quantity_change")
    seed = seed_inventory(products, warehouses).drop("current_stock")
    return seed.join(folded, ["product_id", "warehouse_id"], "left").select(
        "product_id", "warehouse_id",
        F.coalesce(F.col("current_stock"), F.lit(0)).cast("bigint").alias("current_stock"),
        F.coalesce(F.col("skipped"), F.lit(0)).cast("bigint").alias("skipped_changes"),
        F.col("last_event_at").alias("last_updated"),
    )


def skipped_stock_changes(inv: DataFrame) -> DataFrame:
    """The inventory events that were not applied, with the reason."""
    s = skipped_changes(inv, ["product_id", "warehouse_id"], INVENTORY_ORDER, "quantity_change")
    return s.withColumn("reason", F.lit("would produce negative stock"))


__all__ = ["seed_inventory", "seed_metrics", "product_metrics", "inventory_state",
           "skipped_stock_changes", "WAREHOUSES"]
