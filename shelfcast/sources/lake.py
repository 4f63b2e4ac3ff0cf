"""Incremental, date-partitioned Parquet lake."""
from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def read_since(df: DataFrame, ts: str = "timestamp", since=None) -> DataFrame:
    """Rows strictly newer than the cursor (all rows when there is none).

    On a lake table the filter also prunes ``date=`` partitions."""
    if since is None:
        return df
    c = since if isinstance(since, Column) else F.lit(str(since)).cast(df.schema[ts].dataType)
    out = df.filter(F.col(ts) > c)
    if "date" in df.columns:
        out = out.filter(F.col("date") >= F.to_date(c))
    return out


def coerce_for_lake(df: DataFrame, id_cols: Sequence[str] = (), decimals_to_double: bool = False) -> DataFrame:
    """Identifiers as strings; decimals kept exact unless asked otherwise."""
    out = df
    for c in id_cols:
        out = out.withColumn(c, F.col(c).cast("string"))
    if decimals_to_double:
        for f in df.schema.fields:
            if isinstance(f.dataType, DecimalType):
                out = out.withColumn(f.name, F.col(f.name).cast("double"))
    return out


def _write_by_date(df: DataFrame, path: str, ts: str, mode: str) -> None:
    """``path/date=YYYY-MM-DD/``; rows are gathered by date, and AQE splits a large
    day over several tasks and files."""
    (df.withColumn("date", F.to_date(ts)).hint("rebalance", "date")
       .write.mode(mode).partitionBy("date").parquet(path))


def export_table(df: DataFrame, path: str, ts: str = "timestamp", since=None) -> None:
    """Append the rows newer than ``since`` under ``path/date=YYYY-MM-DD/``.

    New files are added next to earlier exports of the same day (the
    reference replaced the day's single file and lost rows)."""
    _write_by_date(read_since(df, ts, since), path, ts, "append")


def _last_run(spark: SparkSession, state_path: str, table: str):
    """(run, cursor) of the newest published cursor, (-1, None) without one."""
    try:
        rows = spark.read.schema("cursor string, run int").json(os.path.join(state_path, f"cursor_{table}")).collect()
    except AnalysisException:
        return -1, None
    return max(((r["run"], r["cursor"]) for r in rows), default=(-1, None))


def load_cursor(spark: SparkSession, state_path: str, table: str):
    """The last exported event time of ``table`` (None when absent)."""
    return _last_run(spark, state_path, table)[1]


def save_cursor(spark: SparkSession, state_path: str, table: str, value, run: int | None = None) -> None:
    """Publish the cursor of a run under a new name; earlier ones stay, so there
    is one at any time."""
    run = _last_run(spark, state_path, table)[0] + 1 if run is None else run
    spark.createDataFrame([(None if value is None else str(value),)], "cursor string") \
        .coalesce(1).write.mode("overwrite").json(os.path.join(state_path, f"cursor_{table}", f"run={run}"))


def export_all(spark: SparkSession, targets: dict[str, tuple[DataFrame, str]], lake_root: str,
               state_path: str, reset: bool = False) -> DataFrame:
    """Export every target incrementally from its cursor, then advance it.

    ``targets``: name -> (frame, timestamp column). A run takes the rows after the
    cursor up to the newest time seen when it began, and writes them under its own
    ``run=N/date=...``; the cursor comes last. A run that failed before that is
    repeated under the same number and replaces its files. Returns one row per table
    (table, exported_rows, cursor)."""
    out = []
    for name, (df, ts) in targets.items():
        last, cursor = _last_run(spark, state_path, name)
        since = None if reset else cursor
        new = read_since(df, ts, since)
        upto = new.agg(F.max(ts)).first()[0]
        n = 0
        if upto is not None:
            path = os.path.join(lake_root, name, f"run={last + 1}")
            _write_by_date(new.filter(F.col(ts) <= F.lit(str(upto)).cast(df.schema[ts].dataType)), path, ts, "overwrite")
            n = spark.read.parquet(path).count()
            save_cursor(spark, state_path, name, upto, last + 1)
        out.append((name, n, since if upto is None else str(upto)))
    return spark.createDataFrame(out, "table string, exported_rows bigint, cursor string")


def materialize(spark: SparkSession, views: dict[str, DataFrame], tables: dict[str, DataFrame], out_root: str) -> DataFrame:
    """Staging models as temp views, marts written as tables."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    rows = []
    for name, df in tables.items():
        path = os.path.join(out_root, name)
        df.write.mode("overwrite").parquet(path)
        rows.append((name, "table", path))
    rows += [(n, "view", None) for n in views]
    return spark.createDataFrame(rows, "name string, kind string, location string")
