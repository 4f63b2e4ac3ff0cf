"""Exponential smoothing of zero-filled series as one aggregation.

``y_1 = x_1, y_t = (1-a) y_(t-1) + a x_t`` composes to a weighted sum, in which the weight of
a value depends on its place ``t`` alone: ``(1-a)**(n-1)`` for the first and
``a (1-a)**(n-t)`` for the others. So no series is collected or walked, a missing value
(a zero) needs no row, and the sums are partial before the shuffle.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ewm_levels(values: DataFrame, keys: Sequence[str], order: str, value: str, alpha: float, back: int = 4) -> DataFrame:
    """Per key: ``n`` and ``last`` (count and greatest of the places of any key), ``y`` (the
    level there) and ``p1..p<back>`` (the levels so many places earlier; NULL before the
    first). A series has one value or none a place, and places are all values of ``order``
    in ``values``, which is read twice: give a written table. Rows without a place or a
    value take no part. The places (hours, say) are numbered in one task: their count grows
    with the time covered, not with the rows."""
    a = float(alpha)
    rows = values.where(F.col(order).isNotNull() & F.col(value).isNotNull())
    every = Window.partitionBy(F.lit(0))
    places = rows.select(order).distinct().select(
        order, F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(order)).alias("_t"),
        F.count(F.lit(1)).over(every).alias("_n"), F.max(order).over(every).alias("_last"))

    def level(k: int) -> Column:
        t, m = F.col("_t"), F.col("_n") - k
        weight = F.when(t == 1, F.pow(F.lit(1 - a), m - 1)).otherwise(F.lit(a) * F.pow(F.lit(1 - a), m - t))
        return F.sum(F.when(t <= m, weight * F.col(value)).otherwise(F.lit(0.0)))
    out = rows.join(places, order).groupBy(*keys, "_n", "_last").agg(
        level(0).alias("y"), *[level(k).alias(f"p{k}") for k in range(1, back + 1)])
    return out.select(*keys, F.col("_n").alias("n"), F.col("_last").alias("last"), "y",
                      *[F.when(F.col("_n") > k, F.col(f"p{k}")).alias(f"p{k}") for k in range(1, back + 1)])
