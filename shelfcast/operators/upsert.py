"""Keyed state maintenance without a table format: dedup-append and upsert."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from .latest import latest_by


def append_dedup(new: DataFrame, existing: DataFrame | None, key: str) -> DataFrame:
    """Rows of ``new`` whose ``key`` is neither repeated within ``new`` nor present
    in ``existing`` (``INSERT ... ON CONFLICT (key) DO NOTHING``)."""
    fresh = new.dropDuplicates([key])
    if existing is None:
        return fresh
    return fresh.join(existing.select(key), key, "left_anti")


def upsert(current: DataFrame, updates: DataFrame, keys: Sequence[str],
           order: Sequence[str | Column]) -> DataFrame:
    """Merge ``updates`` into ``current``: per key keep the row with the greatest
    ``order`` (event time + tie-break), so a late, older update never replaces a
    newer row. Both inputs must share a schema."""
    return latest_by(current.unionByName(updates), keys, order)
