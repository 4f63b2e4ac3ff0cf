"""What the operators share: session settings, written stages, word splitting."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

# White space that separates words in the contracts: blank and \t \n \v \f \r.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

# Arrow batches are bounded by rows and bytes: texts can be very long.
BATCH_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}
# Row groups are buffered whole by every writing task, and rows may hold long texts.
ROW_GROUP = 32 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the Python workers and bound the Arrow batches."""
    ship_package(spark)
    for k, v in BATCH_CONF.items():
        spark.conf.set(k, v)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder named by ``spark.checkpoint.dir``."""
    return scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex[:12]}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Later passes read the files instead of computing the stage again, a lost
    executor costs no more than the tasks that ran on it, and the optimizer
    knows the size of what it joins."""
    path = stage_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Stages:
    """Written stages of one operator call, removed as soon as they are of no more use.

    A stage may be removed only if nothing that is still to run reads it."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        path = stage_path(self.spark, name)
        df.write.option("parquet.block.size", ROW_GROUP).parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = (out, path)
        return out

    def remove(self, df: DataFrame) -> None:
        found = self.paths.pop(id(df), None)
        if found:
            remove_path(self.spark, found[1])

    def remove_all_but(self, *kept: DataFrame) -> None:
        for key, (df, _) in list(self.paths.items()):
            if not any(df is k for k in kept):
                self.remove(df)


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that this package wrote, by Hadoop's file systems as Spark does."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def text_of(column: str) -> Column:
    """The text; a null counts as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE_CLASS + "+"), lambda w: w != "")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
