"""Dense grids for reshapes that must show empty cells as 0."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def densify(values: DataFrame, axes: Sequence[DataFrame], keys: Sequence[str],
            fill_cols: Sequence[str]) -> DataFrame:
    """Cross the (small, derived) axis frames and left-join ``values`` onto the
    grid, filling missing measures with 0. Axis frames are bounded by design
    (hours of the observed span, a few categories, 7x24 slots)."""
    grid = axes[0]
    for ax in axes[1:]:
        grid = grid.crossJoin(F.broadcast(ax))
    out = grid.join(values, list(keys), "left")
    for c in fill_cols:
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)))
    return out


def int_axis(spark, name: str, start: int, stop_inclusive: int) -> DataFrame:
    return spark.range(start, stop_inclusive + 1).select(F.col("id").cast("int").alias(name))
