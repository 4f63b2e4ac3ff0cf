"""RFM customer segmentation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import DEVICES, SEGMENT_ORDER, in_list_position, rfm_segment, rnd, seconds_between
from ..operators.distinct import distinct_counts
from ..operators.rank import quantile_scores
from ..operators.stats import describe_by, histogram
from ..session import materialize
from .common import as_of_col


def _purchases(ev: DataFrame) -> DataFrame:
    return ev.filter(F.col("event_type") == "purchase")


def purchase_overview(ev: DataFrame, approx: bool = False) -> DataFrame:
    """Purchase events, buyers, sessions, first/last date, AOV and GMV
    (``approx`` = HyperLogLog++ distinct counts for very large inputs)."""
    p = F.coalesce(F.col("product_price"), F.lit(0)).cast("double")
    return distinct_counts(
        _purchases(ev), {"unique_buyers": "user_id", "unique_purchase_sessions": "session_id"},
        F.count(F.lit(1)).alias("total_purchase_events"),
        F.to_date(F.min("timestamp")).alias("first_purchase"),
        F.to_date(F.max("timestamp")).alias("last_purchase"),
        rnd(F.avg(p), 2).alias("avg_order_value"),
        rnd(F.sum(F.coalesce(F.col("product_price"), F.lit(0))), 2).alias("total_gmv"),
        approx=approx)


def purchases_per_user(ev: DataFrame) -> DataFrame:
    """R2/A10: how many users made exactly k purchases (count of counts)."""
    per_user = _purchases(ev).groupBy("user_id").agg(F.count(F.lit(1)).alias("purchases"))
    return per_user.groupBy("purchases").agg(F.count(F.lit(1)).alias("user_count"))


def purchase_histogram(ev: DataFrame, n_bins: int = 30) -> DataFrame:
    """Equal-width histogram of purchases per user."""
    per_user = _purchases(ev).groupBy("user_id").agg(F.count(F.lit(1)).alias("purchase_count"))
    return histogram(per_user, [], "purchase_count", n_bins)


def rfm_raw(ev: DataFrame, as_of=None) -> DataFrame:
    """Per buyer frequency, monetary (2 places), recency in days (1 place)."""
    at = as_of_col(ev, as_of)
    return _purchases(ev).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("frequency"),
        rnd(F.sum(F.coalesce(F.col("product_price"), F.lit(0))), 2).alias("monetary"),
        rnd(seconds_between(at, F.max("timestamp")) / 86400.0, 1).alias("recency_days"),
    ).filter(F.col("frequency") > 0)


def rfm_describe(raw: DataFrame) -> DataFrame:
    """describe() of the three raw measures, one row per measure
    (the measures are stacked so one set of passes serves all three)."""
    long = raw.select("user_id", F.inline(F.array(*[
        F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("v")) for c in
        ["recency_days", "frequency", "monetary"]])))
    return describe_by(long, ["measure"], "v")


def rfm_scores(raw: DataFrame, n_bins: int = 5) -> DataFrame:
    """Quintile scores on exact global ranks (ties broken by user_id);
    recency is inverted (recent buyers score high). Adds segment (R5)."""
    s = quantile_scores(materialize(raw, "rfm"), "user_id", {
        "R": ("recency_days", True), "F": ("frequency", False), "M": ("monetary", False)}, n_bins)
    return s.withColumn("RFM_sum", F.col("R") + F.col("F") + F.col("M")) \
            .withColumn("segment", rfm_segment(F.col("R"), F.col("F"), F.col("M")))


def rf_matrix(rfm: DataFrame) -> DataFrame:
    """Users by R (rows) x F (columns 1..5), zero filled."""
    return (rfm.groupBy("R").pivot("F", [1, 2, 3, 4, 5]).agg(F.count(F.lit(1)))
               .na.fill(0)
               .select("R", *[F.col(str(i)).cast("bigint").alias(f"F{i}") for i in range(1, 6)]))


def segment_sizes(rfm: DataFrame) -> DataFrame:
    """Users per segment with the fixed segment order."""
    return (rfm.groupBy("segment").agg(F.count(F.lit(1)).alias("users"))
               .withColumn("segment_order", in_list_position(F.col("segment"), SEGMENT_ORDER).cast("int")))


def segment_revenue(rfm: DataFrame) -> DataFrame:
    """Total spend per segment."""
    return rfm.groupBy("segment").agg(rnd(F.sum("monetary"), 2).alias("total_spend"))


def segment_profiles(rfm: DataFrame) -> DataFrame:
    """Per segment users and mean R/F/M values and scores."""
    return rfm.groupBy("segment").agg(
        F.count(F.lit(1)).alias("users"),
        rnd(F.avg("recency_days"), 2).alias("avg_recency_days"),
        rnd(F.avg("frequency"), 2).alias("avg_frequency"),
        rnd(F.avg("monetary"), 2).alias("avg_monetary"),
        rnd(F.sum("monetary"), 2).alias("total_spend"),
        rnd(F.avg("R"), 2).alias("avg_R_score"),
        rnd(F.avg("F"), 2).alias("avg_F_score"),
        rnd(F.avg("M"), 2).alias("avg_M_score"),
    )


def preferred_device(ev: DataFrame, rfm: DataFrame) -> DataFrame:
    """Each buyer's device with most purchases (ties: first by name)."""
    per = _purchases(ev).groupBy("user_id", "device_type").agg(F.count(F.lit(1)).alias("purchase_count"))
    top = per.groupBy("user_id").agg(
        F.min_by("device_type", F.struct(-F.col("purchase_count"), F.col("device_type"))).alias("device_type"))
    return top.join(rfm.select("user_id", "segment"), "user_id")


def device_by_segment(pref: DataFrame) -> DataFrame:
    """Users per (segment, preferred device)."""
    return pref.groupBy("segment", "device_type").agg(F.count(F.lit(1)).alias("users"))


def device_share(by_segment: DataFrame) -> DataFrame:
    """Device share (pct, 1 place) within each segment, pivoted."""
    tot = by_segment.groupBy("segment").agg(F.sum("users").alias("_t"))
    pct = by_segment.join(tot, "segment").withColumn("pct", rnd(F.col("users") / F.col("_t") * 100.0, 1))
    return (pct.groupBy("segment").pivot("device_type", DEVICES).agg(F.first("pct"))
               .na.fill(0.0))
