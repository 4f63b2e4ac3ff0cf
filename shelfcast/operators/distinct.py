"""Several distinct counts in one row without copying the rows."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_counts(df: DataFrame, distinct: dict[str, str | Sequence[str]], *aggs: Column,
                    approx: bool = False) -> DataFrame:
    """One row: ``aggs`` over ``df`` and, under each name of ``distinct``, COUNT(DISTINCT
    its column or columns).

    Several COUNT(DISTINCT) in one aggregate expand every row into a copy a column. Here
    each is its own aggregate, whose scan reads its column alone and which reduces to
    distinct values before the shuffle; the one-row results are put side by side. As in
    SQL, a row with a NULL in any of the columns does not count. Of no rows the counts
    are 0. ``df`` is planned once a count, so it should be a scan with filters; what is
    dear to compute is written first. ``approx``: HyperLogLog++ estimates of single
    columns in one pass instead, one small sketch a task."""
    if approx:
        return df.agg(*aggs, *[F.approx_count_distinct(c, 0.01).alias(name) for name, c in distinct.items()])
    out = df.agg(*aggs) if aggs else None
    for name, cols in distinct.items():
        cols = [cols] if isinstance(cols, str) else list(cols)
        one = df.select(*cols).dropna("any").distinct().agg(F.count(F.lit(1)).alias(name))
        out = one if out is None else out.crossJoin(F.broadcast(one))  # one row each
    return out
