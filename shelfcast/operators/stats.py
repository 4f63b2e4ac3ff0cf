"""Distribution summaries: quantiles, describe, equal-width histograms, box summaries.

Everything starts from counts per (group, value), a partial aggregate that
collapses repeated values map-side and is written once. Quantiles are read off
the running counts; the running sum goes through equal-width bins of a group's
value range first, so no task orders all values of a group. A NULL group is a
group like any other.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import rnd
from ..session import materialize

BINS = 4096


def _join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; the keys of ``left`` stay."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, on, how).drop(*[f"_r_{k}" for k in keys])


def value_counts(df: DataFrame, groups: Sequence[str], value: str) -> DataFrame:
    """Non-null values as ``_v`` and how often each occurs in its group (``_n``); ``_g``
    is a constant, so that a query without groups has one."""
    v = F.col(value).cast("double")
    return materialize(df.filter(v.isNotNull()).groupBy(F.lit(0).alias("_g"), *groups, v.alias("_v"))
                       .agg(F.count(F.lit(1)).alias("_n")), "value-counts")


def quantiles_from_counts(counts: DataFrame, groups: Sequence[str],
                          probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Linear-interpolated quantiles per group: ``_g``, groups, ``_total``, ``q<100p>``.

    For p the order statistics around h = (N-1)p are the smallest values whose
    running count reaches floor(h)+1 and ceil(h)+1."""
    keys = ["_g", *groups]
    sizes = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    share = (F.col("_v") - F.col("_lo")) / F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0.0))
    c = _join_groups(counts, sizes, keys).withColumn(
        "_bin", F.least(F.floor(F.coalesce(share, F.lit(0.0)) * BINS), F.lit(BINS - 1)).cast("int"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (c.groupBy(*keys, "_bin").agg(F.sum("_n").alias("_k"))
               .select(*keys, "_bin", F.coalesce(F.sum("_k").over(before), F.lit(0)).alias("_offset")))
    within = Window.partitionBy(*keys, "_bin").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    c = _join_groups(c.withColumn("_within", F.sum("_n").over(within)), offsets, [*keys, "_bin"])
    reached = F.col("_offset") + F.col("_within")
    aggs, out = [], []
    for p in probs:
        name, h = f"q{int(round(p * 100))}", (F.col("_total") - 1) * F.lit(float(p))
        aggs += [F.min(F.when(reached >= F.floor(h) + 1, F.col("_v"))).alias(f"_a{name}"),
                 F.min(F.when(reached >= F.ceil(h) + 1, F.col("_v"))).alias(f"_b{name}")]
        out.append((F.col(f"_a{name}") + (h - F.floor(h)) * (F.col(f"_b{name}") - F.col(f"_a{name}"))).alias(name))
    return c.groupBy(*keys, "_total").agg(*aggs).select(*keys, "_total", *out)


def exact_quantiles(df: DataFrame, groups: Sequence[str], value: str,
                    probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Quantiles as SQL ``quantile_cont`` per group, columns ``q<100p>``."""
    return quantiles_from_counts(value_counts(df, groups, value), groups, probs).drop("_g", "_total")


def describe_by(df: DataFrame, groups: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """pandas ``describe()`` of ``value`` per group: count, mean, std (sample),
    min, q25, q50, q75, max; rounded to ``digits``."""
    groups = list(groups)
    keys = ["_g", *groups]
    counts = value_counts(df, groups, value)
    v, n = F.col("_v"), F.col("_n")
    mean = counts.groupBy(*keys).agg(F.sum(n).alias("count"), (F.sum(v * n) / F.sum(n)).alias("mean"),
                                     F.min(v).alias("min"), F.max(v).alias("max"))
    spread = (_join_groups(counts, mean, keys).groupBy(*keys, "count", "mean", "min", "max")
              .agg(F.sum(n * (v - F.col("mean")) * (v - F.col("mean"))).alias("_ss")))
    q = quantiles_from_counts(counts, groups).drop("_total")
    out = _join_groups(spread, q, keys).withColumn(
        "std", F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1))))
    return out.select(*groups, F.col("count").cast("bigint").alias("count"),
                      *[rnd(c, digits).alias(c) for c in ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def histogram(df: DataFrame, groups: Sequence[str], value: str, n_bins: int) -> DataFrame:
    """Equal-width histogram per group over [min, max]: bin = min(floor((x-min)/w), n-1).

    Output: groups, bin, bin_start, bin_end, count (empty bins omitted).
    """
    groups = list(groups)
    keys = ["_g", *groups]
    v = F.col(value).cast("double")
    rows = df.filter(v.isNotNull()).withColumn("_g", F.lit(0))
    rng = rows.groupBy(*keys).agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    d = _join_groups(rows, rng, keys)
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(n_bins))
    b = F.when(w == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - F.col("_lo")) / w), F.lit(n_bins - 1))).cast("int")
    counted = d.groupBy(*groups, b.alias("bin"), "_lo", "_hi").agg(F.count(F.lit(1)).alias("count"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(n_bins))
    return counted.select(*groups, "bin",
                          rnd(F.col("_lo") + F.col("bin") * width, 6).alias("bin_start"),
                          rnd(F.col("_lo") + (F.col("bin") + 1) * width, 6).alias("bin_end"),
                          F.col("count").cast("bigint").alias("count"))


def box_summary(df: DataFrame, groups: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Box-plot numbers per group: min, q1, median, q3, max and the 1.5*IQR
    whiskers (most extreme observations inside the fences)."""
    groups = list(groups)
    keys = ["_g", *groups]
    counts = value_counts(df, groups, value)
    v = F.col("_v")
    fences = quantiles_from_counts(counts, groups).select(
        *keys, "q25", "q50", "q75", (F.col("q25") - 1.5 * (F.col("q75") - F.col("q25"))).alias("_lf"),
        (F.col("q75") + 1.5 * (F.col("q75") - F.col("q25"))).alias("_uf"))
    agg = _join_groups(counts, fences, keys).groupBy(*keys, "q25", "q50", "q75").agg(
        F.min(v).alias("min"), F.max(v).alias("max"),
        F.min(F.when(v >= F.col("_lf"), v)).alias("lower_whisker"),
        F.max(F.when(v <= F.col("_uf"), v)).alias("upper_whisker"),
        F.coalesce(F.sum(F.when((v < F.col("_lf")) | (v > F.col("_uf")), F.col("_n"))), F.lit(0))
        .cast("bigint").alias("outliers"))
    return agg.select(*groups, *[rnd(c, digits).alias(c) for c in
                                 ["min", "lower_whisker", "q25", "q50", "q75", "upper_whisker", "max"]],
                      "outliers")
