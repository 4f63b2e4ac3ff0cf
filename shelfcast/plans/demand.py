"""Demand and inventory analytics."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.columns import DOW_LABELS, iso_dow, rnd, safe_div, seconds_between
from ..operators.distinct import distinct_counts
from ..operators.grid import densify, int_axis
from ..operators.smoothing import ewm_levels
from ..session import materialize


def _purchases(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type") == "purchase")


def _per_hour_rate(n, first, last):
    return safe_div(n, seconds_between(last, first) / 3600.0)


def demand_overview(ev: DataFrame, approx: bool = False) -> DataFrame:
    """Purchases, buyers, products, first/last, purchases per hour
    (``approx`` = HyperLogLog++ distinct counts for very large inputs)."""
    return distinct_counts(
        _purchases(ev), {"unique_buyers": "user_id", "distinct_products_bought": "product_id"},
        F.count(F.lit(1)).alias("total_purchases"),
        F.min("timestamp").alias("first_purchase"),
        F.max("timestamp").alias("last_purchase"),
        rnd(_per_hour_rate(F.count(F.lit(1)), F.min("timestamp"), F.max("timestamp")), 2).alias("purchases_per_hour"),
        approx=approx)


def daily_purchases(ev: DataFrame) -> DataFrame:
    """Purchases per UTC day."""
    return _purchases(ev).groupBy(F.to_date("timestamp").alias("day")).agg(F.count(F.lit(1)).alias("purchases"))


def hourly_category_demand(ev: DataFrame, products: DataFrame) -> DataFrame:
    """Purchases per (hour bucket, category); reduced to (hour, product)
    before the catalogue join."""
    per = (_purchases(ev).filter(F.col("product_id").isNotNull())
           .groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket"), "product_id")
           .agg(F.count(F.lit(1)).alias("n")))
    return (per.join(products.select("product_id", "category"), "product_id")
               .groupBy("hour_bucket", "category").agg(F.sum("n").cast("bigint").alias("purchases")))


def category_totals(hourly: DataFrame) -> DataFrame:
    """Total, mean and sample std of hourly purchases per category."""
    return hourly.groupBy("category").agg(
        F.sum("purchases").cast("bigint").alias("total"),
        rnd(F.avg("purchases"), 2).alias("avg_per_hour"),
        rnd(F.stddev_samp("purchases"), 2).alias("std_per_hour"))


def hourly_total(ev: DataFrame) -> DataFrame:
    return _purchases(ev).groupBy(F.date_trunc("hour", "timestamp").alias("hour_bucket")).agg(
        F.count(F.lit(1)).alias("purchases"))


def moving_averages(ev: DataFrame, windows=(1, 3)) -> DataFrame:
    """Rolling means over the observed hourly series (min_periods=1).

    The series has one row per observed hour (bounded by the time span, not
    by the event volume), so the ordered window over it is cheap.
    """
    h = hourly_total(ev)
    w = Window.orderBy("hour_bucket")
    out = h
    for k in windows:
        out = out.withColumn(f"ma_{k}h", rnd(F.avg("purchases").over(w.rowsBetween(-(k - 1), 0)), 6))
    return out


def series_stats(ev: DataFrame) -> DataFrame:
    """Mean, sample std, max and min of hourly purchases."""
    return hourly_total(ev).agg(
        rnd(F.avg("purchases"), 2).alias("mean_per_hour"),
        rnd(F.stddev_samp("purchases"), 2).alias("std_per_hour"),
        F.max("purchases").alias("peak_hour_count"),
        F.min("purchases").alias("lowest_hour_count"))


def demand_heatmap(ev: DataFrame) -> DataFrame:
    """Dense 7x24 grid of purchases by ISO weekday and hour (long form,
    zero filled, with the day label)."""
    counts = _purchases(ev).groupBy(iso_dow(F.col("timestamp")).cast("int").alias("day_of_week"),
                                    F.hour("timestamp").cast("int").alias("hour_of_day")).agg(
        F.count(F.lit(1)).alias("purchases"))
    spark = ev.sparkSession
    grid = densify(counts, [int_axis(spark, "day_of_week", 1, 7), int_axis(spark, "hour_of_day", 0, 23)],
                   ["day_of_week", "hour_of_day"], ["purchases"])
    labels = F.array(*[F.lit(x) for x in DOW_LABELS])
    return grid.select("day_of_week", F.element_at(labels, F.col("day_of_week")).alias("day_name"),
                       "hour_of_day", F.col("purchases").cast("bigint").alias("purchases"))


def heatmap_wide(heat: DataFrame) -> DataFrame:
    """The heatmap pivoted to one column per hour (explicit 0..23)."""
    return heat.groupBy("day_of_week", "day_name").pivot("hour_of_day", list(range(24))).agg(F.first("purchases"))


def peak_slots(ev: DataFrame, k: int = 5) -> DataFrame:
    """Busiest (weekday, hour) slots; ties by weekday then hour."""
    h = demand_heatmap(ev).filter(F.col("purchases") > 0)
    return h.orderBy(F.desc("purchases"), "day_of_week", "hour_of_day").limit(k)


def category_ranking(hourly: DataFrame) -> DataFrame:
    """Total, mean, std, hours with sales and coefficient of variation."""
    a = hourly.groupBy("category").agg(
        F.sum("purchases").cast("bigint").alias("total_purchases"),
        F.avg("purchases").alias("_m"), F.stddev_samp("purchases").alias("_s"),
        F.count("purchases").alias("hours_with_sales"))
    return a.select("category", "total_purchases", rnd("_m", 2).alias("avg_per_hour"),
                    rnd("_s", 2).alias("std_per_hour"), "hours_with_sales",
                    rnd(safe_div(F.col("_s"), F.col("_m")), 2).alias("cv"))


def demand_forecast(hourly: DataFrame, hours: int = 6, span: int = 4, decay: float = 0.85) -> DataFrame:
    """EWM (adjust=False, alpha = 2/(span+1)) level and 4-step trend per
    category over the hours seen in any category (zero filled), then
    f(n) = max(0, level + trend * n * decay**n) for n = 1..hours.

    The hourly table (a row an hour and category) is written once; levels are weighted
    sums over it. Purchases without a time take no part.
    """
    alpha = 2.0 / (span + 1)
    e = ewm_levels(materialize(hourly.select("hour_bucket", "category", "purchases"), "hourly"),
                   ["category"], "hour_bucket", "purchases", alpha)
    k = F.least(F.col("n") - 1, F.lit(4))
    back = F.when(k == 1, F.col("p1")).when(k == 2, F.col("p2")).when(k == 3, F.col("p3")).when(k == 4, F.col("p4"))
    trend = F.when(k >= 1, (F.col("y") - back) / k)
    st = e.select("category", F.col("last").alias("last_hour"), F.col("y").alias("level"), trend.alias("trend"))
    steps = F.sequence(F.lit(1), F.lit(hours))
    out = st.select("category", "last_hour", "level", "trend", F.explode(steps).alias("step"))
    val = F.when(F.col("trend").isNull(), F.lit(0.0)).otherwise(
        F.greatest(F.lit(0.0), F.col("level") + F.col("trend") * F.col("step") * F.pow(F.lit(decay), F.col("step"))))
    return out.select(
        (F.col("last_hour") + F.make_dt_interval(hours=F.col("step"))).alias("hour"),
        "category", "step",
        rnd(val, 2).alias("forecast_purchases"),
        rnd(F.col("level"), 4).alias("ewm_level"),
        rnd(F.col("trend"), 4).alias("ewm_trend"))


def forecast_wide(fc: DataFrame, categories: list[str]) -> DataFrame:
    """Forecast pivoted to one column per category (explicit list)."""
    return fc.groupBy("hour").pivot("category", categories).agg(F.first("forecast_purchases"))


def stock_and_rate(stock: DataFrame, ev: DataFrame, products: DataFrame) -> DataFrame:
    """Total stock per product and its purchase rate per hour over its
    own observed purchase span (single purchase -> NULL -> 0)."""
    inv = (stock.groupBy("product_id").agg(F.sum("current_stock").alias("total_stock"))
                .join(products.select("product_id", "product_name", "category"), "product_id"))
    rate = (_purchases(ev).filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("total_purchases"),
        rnd(_per_hour_rate(F.count(F.lit(1)), F.min("timestamp"), F.max("timestamp")), 4).alias("purchases_per_hour")))
    j = inv.join(rate, "product_id", "left")
    return j.select("product_id", "product_name", "category", F.col("total_stock").cast("bigint").alias("total_stock"),
                    F.coalesce(F.col("purchases_per_hour"), F.lit(0.0)).alias("purchases_per_hour"))


def stockout_horizon(sr: DataFrame, critical: float = 24.0, warning: float = 72.0) -> DataFrame:
    """Hours until stock-out (1 place) and urgency status."""
    h = rnd(safe_div(F.col("total_stock"), F.col("purchases_per_hour")), 1)
    out = sr.withColumn("hours_until_stockout", h)
    status = (F.when(F.col("hours_until_stockout").isNull(), "No Demand")
               .when(F.col("hours_until_stockout") == 0, "Out of Stock")
               .when(F.col("hours_until_stockout") < F.lit(critical), f"Critical (<{critical:g}h)")
               .when(F.col("hours_until_stockout") < F.lit(warning), f"Warning (<{warning:g}h)")
               .otherwise("Healthy"))
    return out.withColumn("status", status)


def at_risk(horizon: DataFrame) -> DataFrame:
    """Products whose status is Out of Stock, Critical or Warning."""
    return horizon.filter(~F.col("status").isin("No Demand", "Healthy"))


def status_counts(horizon: DataFrame) -> DataFrame:
    """Products per status."""
    return horizon.groupBy("status").agg(F.count(F.lit(1)).alias("products"))

