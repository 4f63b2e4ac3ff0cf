"""Shared plan helpers: as-of resolution and look-back filters."""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_of_col(df: DataFrame, as_of=None, ts: str = "timestamp") -> Column:
    """The reference time of an analysis.

    ``None`` -> the latest event time of ``df`` as a lazy scalar subquery (the
    reference used wall-clock NOW(), which makes results irreproducible);
    otherwise a literal cast to the type of ``df[ts]``.
    """
    if as_of is None:
        return df.agg(F.max(ts)).scalar()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, (_dt.datetime, _dt.date)):
        as_of = as_of.isoformat(sep=" ") if isinstance(as_of, _dt.datetime) else as_of.isoformat()
    return F.lit(as_of).cast(df.schema[ts].dataType)


def interval(spec: str) -> Column:
    """'7 days' -> INTERVAL '7 days'."""
    return F.expr(f"INTERVAL '{spec}'")


def within_lookback(df: DataFrame, lookback: str | None, as_of=None, ts: str = "timestamp") -> DataFrame:
    """Rows with ts > as_of - lookback (all rows when lookback is None)."""
    if lookback is None:
        return df
    return df.filter(F.col(ts) > as_of_col(df, as_of, ts) - interval(lookback))
