"""Staging views (P1, P2, X1) over the raw domain tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import iso_dow
from ..operators.latest import latest_by

COMPETITOR_ORDER = ["timestamp", "src_order", "src_line", "competitor_price"]


def stg_clickstream(ev: DataFrame) -> DataFrame:
    """Typed clickstream with hour of day and ISO day of week."""
    return ev.select(
        "event_id", "user_id", "session_id", "event_type", "product_id",
        F.col("product_price").cast("decimal(10,2)").alias("product_price"),
        "device_type",
        F.col("timestamp").alias("event_timestamp"),
        F.hour("timestamp").cast("int").alias("hour_of_day"),
        iso_dow(F.col("timestamp")).cast("int").alias("day_of_week"),
    )


def stg_inventory(inv: DataFrame) -> DataFrame:
    """Inventory events with absolute quantity."""
    return inv.select(
        "event_id", "product_id", "warehouse_id", "event_type", "quantity_change",
        F.abs("quantity_change").alias("absolute_quantity"),
        F.col("timestamp").alias("event_timestamp"),
    )


def stg_competitor_prices(cp: DataFrame) -> DataFrame:
    """Latest observation per (product, competitor), typed."""
    return typed_prices(latest_by(cp, ["product_id", "competitor_name"], COMPETITOR_ORDER))


def typed_prices(latest: DataFrame) -> DataFrame:
    """X1 from the latest row per (product, competitor)."""
    return latest.select(
        "product_id", "competitor_name",
        F.col("competitor_price").cast("decimal(10,2)").alias("competitor_price"),
        F.col("our_price").cast("decimal(10,2)").alias("our_price"),
        F.col("price_difference").cast("decimal(10,2)").alias("price_difference"),
        F.col("price_difference_pct").cast("decimal(6,2)").alias("price_difference_pct"),
        F.col("timestamp").alias("observed_at"),
    )
