"""Competitive price position and price-change simulation."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import COMPETITORS, rnd, safe_div
from ..operators.distinct import distinct_counts
from ..operators.latest import latest_by
from ..operators.stats import box_summary, describe_by, histogram


def latest_recs(recs: DataFrame) -> DataFrame:
    """The newest recommendation per product."""
    return latest_by(recs, ["product_id"], ["timestamp"])


def price_overview(cp: DataFrame, recs: DataFrame) -> DataFrame:
    """Seven scalar facts from two one-row aggregates."""
    a = distinct_counts(cp, {"products_tracked": "product_id", "competitors": "competitor_name"},
                        F.count(F.lit(1)).alias("total_price_obs"),
                        F.to_date(F.min("timestamp")).alias("earliest_obs"),
                        F.to_date(F.max("timestamp")).alias("latest_obs"))
    b = recs.agg(F.count_distinct("product_id").alias("products_with_rec"),
                 F.count(F.lit(1)).alias("total_recs"))
    return a.crossJoin(b)


def category_price_position(recs: DataFrame, products: DataFrame) -> DataFrame:
    """K2: per category mean own price, mean competitor price, mean pct above."""
    pr = latest_recs(recs).join(products.select("product_id", "category"), "product_id")
    pct = safe_div(F.col("current_price") - F.col("avg_competitor_price"), F.col("avg_competitor_price")) * 100.0
    return pr.groupBy("category").agg(
        rnd(F.avg("current_price"), 2).alias("avg_our_price"),
        rnd(F.avg("avg_competitor_price"), 2).alias("avg_comp_price"),
        rnd(F.avg(pct), 1).alias("avg_pct_above_comp"),
        F.count_distinct("product_id").alias("products"))


def price_position(recs: DataFrame, products: DataFrame) -> DataFrame:
    """K3: pct of our price vs the competitor average per product (1 place)."""
    pr = latest_recs(recs).join(products.select("product_id", "category"), "product_id")
    pct = safe_div(F.col("current_price") - F.col("avg_competitor_price"), F.col("avg_competitor_price")) * 100.0
    return pr.select("product_id", "product_name", "category", "current_price", "avg_competitor_price",
                     "recommendation", rnd(pct, 1).alias("pct_vs_competitor"))


def above_below_par(pos: DataFrame) -> DataFrame:
    """K4: products priced above, below and at par."""
    v = F.col("pct_vs_competitor")
    return pos.agg(F.count_if(v > 0).alias("above"), F.count_if(v < 0).alias("below"),
                   F.count_if(v == 0).alias("at_par"))


def price_gaps(cp: DataFrame, products: DataFrame) -> DataFrame:
    """K5: every observation's (ours - theirs) / theirs * 100 (2 places), with a
    unique observation key for ordering."""
    j = cp.join(products.select("product_id", "product_name", "category"), "product_id")
    gap = safe_div(F.col("our_price") - F.col("competitor_price"), F.col("competitor_price")) * 100.0
    return j.select("product_id", "product_name", "category", "competitor_name",
                    rnd(gap, 2).alias("pct_above_competitor"),
                    F.struct("timestamp", "src_order", "src_line", "product_id").alias("obs_key"))


def gap_describe(gaps: DataFrame) -> DataFrame:
    """describe() of the gap per competitor."""
    return describe_by(gaps, ["competitor_name"], "pct_above_competitor")


def gap_histogram(gaps: DataFrame, n_bins: int = 40) -> DataFrame:
    """Gap histogram per category."""
    return histogram(gaps, ["category"], "pct_above_competitor", n_bins)


def gap_box(gaps: DataFrame) -> DataFrame:
    """Box-plot numbers of the gap per competitor."""
    return box_summary(gaps, ["competitor_name"], "pct_above_competitor")


def recommendation_table(recs: DataFrame) -> DataFrame:
    """K6: latest recommendation per product with confidence and price change pct."""
    r = latest_recs(recs)
    return r.select("product_id", "product_name", "current_price", "avg_competitor_price", "recommendation",
                    rnd(F.col("confidence_score") * 100.0, 1).alias("confidence_pct"),
                    "recommended_price",
                    rnd(safe_div(F.col("recommended_price") - F.col("current_price"), F.col("current_price")) * 100.0,
                        1).alias("price_change_pct"),
                    "timestamp")


def recommendation_split(recs: DataFrame) -> DataFrame:
    """Products per recommendation."""
    return latest_recs(recs).groupBy("recommendation").agg(F.count(F.lit(1)).alias("count"))


def competitor_landscape(cp: DataFrame, products: DataFrame) -> DataFrame:
    """Per (competitor, product) observations and how often they were cheaper.
    Observations are counted by product before the catalogue joins."""
    counts = cp.groupBy("competitor_name", "product_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("competitor_price") < F.col("our_price")).alias("c"))
    j = counts.join(products.select("product_id", "product_name", "category"), "product_id")
    return j.groupBy("competitor_name", "product_name", "category").agg(
        F.sum("n").alias("observations"), F.sum("c").alias("times_cheaper"),
    ).withColumn("pct_cheaper", rnd(safe_div(F.col("times_cheaper") * 100.0, F.col("observations")), 0))


def undercut_summary(land: DataFrame) -> DataFrame:
    """K9: overall undercut rate per competitor."""
    return land.groupBy("competitor_name").agg(
        F.sum("times_cheaper").alias("times_cheaper"), F.sum("observations").alias("observations"),
    ).withColumn("pct_cheaper", rnd(F.col("times_cheaper") / F.col("observations") * 100.0, 1))


def undercut_matrix(land: DataFrame, by: str = "product_name") -> DataFrame:
    """Mean pct_cheaper by ``by`` x competitor (explicit columns), 0 filled."""
    m = land.groupBy(by).pivot("competitor_name", COMPETITORS).agg(F.avg("pct_cheaper")).na.fill(0.0)
    return m.select(by, *[rnd(F.col(c), 1).alias(c) for c in COMPETITORS])


def revenue_simulation(recs: DataFrame, products: DataFrame, metrics: DataFrame,
                       elasticity: float = -1.5) -> DataFrame:
    """Revenue impact of adopting 'lower' recommendations.

    The 'lower' filter is applied before picking each product's latest row,
    as in the reference."""
    lower = latest_by(recs.filter(F.col("recommendation") == "lower"), ["product_id"], ["timestamp"])
    j = (lower.join(products.select("product_id", "category"), "product_id")
              .join(metrics.select("product_id", "total_purchases", "revenue"), "product_id"))
    now, then, sold = F.col("current_price"), F.col("recommended_price"), F.col("total_purchases")
    price = rnd(safe_div(then - now, now) * 100.0, 2)
    demand = rnd(price * F.lit(elasticity), 2)
    to_sell = rnd(F.greatest(F.lit(0.0), sold * (1 + demand / 100.0)), 0)
    earned, to_earn = rnd(now * sold, 2), rnd(then * to_sell, 2)
    gain = rnd(to_earn - earned, 2)
    measures = {"price_chg_pct": price, "demand_chg_pct": demand, "proj_purchases": to_sell, "current_rev": earned,
                "proj_rev": to_earn, "rev_delta": gain, "rev_delta_pct": rnd(safe_div(gain, earned) * 100.0, 1)}
    return j.select("product_id", "product_name", "category", "current_price", "recommended_price", "total_purchases",
                    *[c.alias(name) for name, c in measures.items()])


def simulation_total(sim: DataFrame) -> DataFrame:
    """Total projected revenue delta."""
    return sim.agg(rnd(F.sum("rev_delta"), 2).alias("total_rev_delta"), F.count(F.lit(1)).alias("products"))
