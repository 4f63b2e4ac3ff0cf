"""Stream sources."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .tables import load


def table_stream(spark: SparkSession, data_dir: str, name: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """File stream over ``<data_dir>/<name>.parquet`` with the batch table's schema.

    New files matching the name are picked up as they land; tests and the
    registered queries run it with ``availableNow``.
    """
    schema = load(spark, data_dir, name).schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(data_dir)


def kafka_stream(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                 max_offsets_per_trigger: int | None = None) -> DataFrame:
    """JSON messages from a Kafka topic (needs the Kafka connector on the classpath)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return r.load().select(F.col("value").cast("string").alias("value"))


def json_lines_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Raw text lines (one JSON message per line) from a landing folder."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


CORRUPT = "_corrupt_record"


def message(value: Column, schema: StructType) -> Column:
    """A JSON message as a struct of ``schema``'s columns and ``CORRUPT``; see ``decodable``."""
    return F.from_json(value, StructType([*schema.fields, StructField(CORRUPT, StringType())]),
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})


def decodable(message: Column) -> Column:
    return message.isNotNull() & message.getField(CORRUPT).isNull()


def parse_events(raw: DataFrame, schema: StructType, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """Decode JSON messages into typed columns.

    Missing keys become NULL and unknown keys are ignored. A message that is no
    JSON object, or has a value of another type than its column, goes to the
    second (dead-letter) frame with its raw text instead of failing the batch.
    """
    parsed = raw.select(F.col(value_col).alias("_raw"), message(F.col(value_col), schema).alias("_m"))
    ok = decodable(F.col("_m"))
    good = parsed.filter(ok).select("_m.*").drop(CORRUPT)
    bad = parsed.filter(~ok).select(F.col("_raw").alias("raw_message"))
    return good, bad
