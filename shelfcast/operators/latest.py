"""Latest row per key (SQL ``DISTINCT ON (keys) ... ORDER BY keys, order DESC``)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
              cols: Sequence[str] | None = None) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` struct.

    Planned as a partial + final aggregation (``max_by``), so a hot key is
    collapsed map-side before the shuffle and no sort of the input is needed.
    ``order`` must end in columns that make it unique within a key when the
    result has to be deterministic.
    """
    keys = list(keys)
    value_cols = [c for c in (cols or df.columns) if c not in keys]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    picked = F.max_by(F.struct(*[F.col(c) for c in value_cols]), F.struct(*order_cols))
    return df.groupBy(*keys).agg(picked.alias("_latest")).select(*keys, "_latest.*")
