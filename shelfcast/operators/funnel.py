"""Distinct sessions reaching each funnel stage, per group (A4).

``COUNT(DISTINCT CASE WHEN stage = s THEN session END)`` for several stages is
planned by Spark as one Expand per distinct aggregate. Here it is rewritten as
two ordinary aggregations: per (group, session) the max of each stage flag
(partial-aggregated map-side, so a hot session or group collapses before the
shuffle), then per group the sum of the flags.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import FUNNEL_STAGES


def stage_flags(df: DataFrame, keys: Sequence[str], stages: Sequence[str] = FUNNEL_STAGES,
                names: Sequence[str] | None = None, stage_col: str = "event_type",
                session_col: str = "session_id") -> DataFrame:
    """One row per (keys, session) with a 0/1 flag per stage; a NULL session reaches none."""
    return df.groupBy(*keys, session_col).agg(*[
        F.max(F.when((F.col(stage_col) == s) & F.col(session_col).isNotNull(), 1).otherwise(0)).alias(n)
        for s, n in zip(stages, names or stages)])


def count_flags(flags: DataFrame, keys: Sequence[str], names: Sequence[str] = FUNNEL_STAGES,
                session_col: str = "session_id") -> DataFrame:
    """Sessions per ``keys`` and stage of rows that may hold a session more than once."""
    per_session = flags.groupBy(*keys, session_col).agg(*[F.max(n).alias(n) for n in names])
    return per_session.groupBy(*keys).agg(*[F.sum(n).cast("bigint").alias(n) for n in names])


def stage_sessions(df: DataFrame, keys: Sequence[str], stages: Sequence[str] = FUNNEL_STAGES,
                   names: Sequence[str] | None = None, stage_col: str = "event_type",
                   session_col: str = "session_id") -> DataFrame:
    names = list(names or stages)
    per_session = stage_flags(df, keys, stages, names, stage_col, session_col)
    return per_session.groupBy(*keys).agg(*[F.sum(n).cast("bigint").alias(n) for n in names])
