"""Table scans (S3)."""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events", "documents", "embeddings", "pages", "benchmark", "labels",
              "conversations"]


def load(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    """Scan ``<data_dir>/<name>.parquet`` (a file or a directory of part files).

    Nothing is selected here: callers project the columns they need so that
    Catalyst prunes the Parquet ReadSchema and pushes filters into the scan.
    """
    return spark.read.parquet(os.path.join(data_dir, f"{name}.parquet"))
