"""Pricing engine (E1-E4): one DataFrame plan instead of a driver-side loop."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DEMAND_HIGH, DEMAND_LOW, recommend, rnd
from .common import as_of_col, within_lookback
from .staging import COMPETITOR_ORDER
from ..operators.latest import latest_by


def demand_velocity(ev: DataFrame, as_of=None, lookback: str = "1 hour") -> DataFrame:
    """Purchases per product within the look-back before ``as_of``."""
    recent = within_lookback(ev.filter((F.col("event_type") == "purchase") & F.col("product_id").isNotNull()),
                             lookback, as_of_col(ev, as_of) if as_of is None else as_of)
    return recent.groupBy("product_id").agg(F.count(F.lit(1)).cast("double").alias("demand_velocity"))


def avg_competitor_price(cp: DataFrame) -> DataFrame:
    """Mean of each competitor's latest price per product, rounded to 2."""
    return avg_of_latest(latest_by(cp.select("product_id", "competitor_name", "competitor_price", *COMPETITOR_ORDER[:-1]),
                                   ["product_id", "competitor_name"], COMPETITOR_ORDER))


def avg_of_latest(latest: DataFrame) -> DataFrame:
    """E2 from the latest row per (product, competitor), which a stream may keep."""
    return latest.groupBy("product_id").agg(
        rnd(F.avg(F.col("competitor_price").cast("double")), 2).alias("avg_competitor_price"))


def pricing_cycle(products: DataFrame, ev: DataFrame, cp: DataFrame | None, as_of=None,
                  lookback: str = "1 hour", high: float = DEMAND_HIGH, low: float = DEMAND_LOW,
                  latest: DataFrame | None = None) -> DataFrame:
    """One recommendation per product that has competitor prices.

    Inner join with the competitor averages (products without competitor data
    are skipped), left join with demand (missing -> 0), then the E3 rule. ``latest``: the
    latest row per (product, competitor) of ``cp``, where it is at hand.
    """
    at = as_of_col(ev, as_of)
    comp = avg_competitor_price(cp) if latest is None else avg_of_latest(latest)
    return recommendations(products, comp, demand_velocity(ev, at, lookback), at, high, low)


def recommendations(products: DataFrame, comp: DataFrame, demand: DataFrame, at: Column,
                    high: float = DEMAND_HIGH, low: float = DEMAND_LOW) -> DataFrame:
    """The E4 rows from competitor averages and demand, wherever they come from."""
    j = (products.select("product_id", "product_name", "base_price")
         .join(comp, "product_id")
         .join(demand, "product_id", "left")
         .withColumn("demand_velocity", F.coalesce(F.col("demand_velocity"), F.lit(0.0))))
    rec = recommend(F.col("base_price"), F.col("avg_competitor_price"), F.col("demand_velocity"), high, low)
    return j.select(
        "product_id", "product_name",
        F.col("base_price").cast("double").alias("current_price"),
        "avg_competitor_price", "demand_velocity",
        rec["recommendation"].alias("recommendation"),
        rec["confidence_score"].alias("confidence_score"),
        rec["recommended_price"].alias("recommended_price"),
        at.alias("timestamp"),
    )
