"""Map the driver's generic test tables onto the retail domain tables.

The mapping is deterministic and written so that the same definitions are
expressible in any SQL engine (the oracle inlines them as CTEs):

  products            <- part
  clickstream_events  <- events
  competitor_prices   <- lineitem x part   (price history, one row per observation)
  inventory_events    <- lineitem

All outputs are lazy DataFrames; only the referenced columns are read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import load

# Fixed values of the mapping (must match the oracle's CTEs).
EVENT_TYPE_MAP = [("signup", "page_view"), ("view", "product_view"), ("click", "add_to_cart"),
                  ("error", "remove_from_cart"), ("purchase", "purchase")]
COMPETITOR_BY_MOD3 = ["TechMart", "GadgetZone", "ElectroHub"]
WAREHOUSE_BY_MOD3 = ["WH-LAGOS", "WH-ABUJA", "WH-PH"]


def _case_map(c: Column, pairs) -> Column:
    out = None
    for k, v in pairs:
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out


def products(spark: SparkSession, data_dir: str) -> DataFrame:
    return load(spark, data_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("base_price"),
    )


def clickstream(spark: SparkSession, data_dir: str) -> DataFrame:
    return clickstream_from(load(spark, data_dir, "events"))


def clickstream_from(ev: DataFrame) -> DataFrame:
    """Map raw ``events`` rows (batch or streaming) to clickstream events."""
    no_product = F.col("event_type") == "signup"
    m = (F.col("user_id") * 3 + F.dayofmonth("ts")) % 20
    return ev.select(
        F.col("event_id"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        _case_map(F.col("event_type"), EVENT_TYPE_MAP).alias("event_type"),
        F.when(~no_product, F.get_json_object("props", "$.k").cast("bigint")).alias("product_id"),
        F.when(~no_product, F.col("value").cast("decimal(10,2)")).alias("product_price"),
        F.when(m < 11, "mobile").when(m < 18, "desktop").otherwise("tablet").alias("device_type"),
        F.col("ts").alias("timestamp"),
    )


def competitor_prices(spark: SparkSession, data_dir: str) -> DataFrame:
    """Price observations; ``src_order``/``src_line`` are the tie-break of equal timestamps."""
    return competitor_prices_from(load(spark, data_dir, "lineitem"), load(spark, data_dir, "part"))


def competitor_prices_from(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """Map raw ``lineitem`` rows (batch or streaming) joined to ``part`` (static)."""
    li = lineitem.select("l_partkey", "l_suppkey", "l_orderkey",
                                                 "l_linenumber", "l_discount", "l_shipdate")
    pt = part.select("p_partkey", "p_retailprice")
    our = F.col("p_retailprice").cast("decimal(10,2)")
    comp = F.round(F.col("p_retailprice").cast("decimal(12,2)")
                   * (F.lit(0.8).cast("decimal(2,1)") + F.lit(4) * F.col("l_discount").cast("decimal(4,2)")),
                   2).cast("decimal(10,2)")
    j = li.join(pt, li.l_partkey == pt.p_partkey)
    out = j.select(
        F.col("l_partkey").alias("product_id"),
        _case_map(F.col("l_suppkey") % 3, list(enumerate(COMPETITOR_BY_MOD3))).alias("competitor_name"),
        comp.alias("competitor_price"),
        our.alias("our_price"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").alias("src_order"),
        F.col("l_linenumber").alias("src_line"),
    )
    diff = F.col("competitor_price") - F.col("our_price")
    pct = F.round((diff.cast("double") / F.col("our_price").cast("double") * 100).cast("decimal(38,6)"), 2)
    return out.select(
        "product_id", "competitor_name", "competitor_price", "our_price",
        diff.cast("decimal(10,2)").alias("price_difference"),
        pct.cast("decimal(6,2)").alias("price_difference_pct"),
        "timestamp", "src_order", "src_line",
    )


def inventory_events(spark: SparkSession, data_dir: str) -> DataFrame:
    return inventory_events_from(load(spark, data_dir, "lineitem"))


def inventory_events_from(lineitem: DataFrame) -> DataFrame:
    """Map raw ``lineitem`` rows (batch or streaming) to inventory events."""
    li = lineitem.select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity",
        "l_returnflag", "l_linestatus", "l_shipdate")
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    q = F.col("l_quantity")
    qty = (F.when(rf.isin("A", "R"), q)
           .when(ls == "O", -q)
           .when(F.col("l_linenumber") % 2 == 0, q)
           .otherwise(-q)).cast("int")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_shipdate").cast("date")).alias("event_id"),
        F.col("l_partkey").alias("product_id"),
        _case_map(F.col("l_suppkey") % 3, list(enumerate(WAREHOUSE_BY_MOD3))).alias("warehouse_id"),
        F.when(rf == "A", "stock_received").when(rf == "R", "stock_returned")
         .when(ls == "O", "stock_damaged").otherwise("manual_adjustment").alias("event_type"),
        qty.alias("quantity_change"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").alias("src_order"),
        F.col("l_linenumber").alias("src_line"),
    )


def warehouses(spark: SparkSession) -> DataFrame:
    """The fixed warehouse list (3 rows; a proven broadcast bound)."""
    return spark.createDataFrame([(w,) for w in WAREHOUSE_BY_MOD3], "warehouse_id string")


class Domain:
    """Lazy accessors for the domain tables of one data directory."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark, self.data_dir = spark, data_dir

    def products(self) -> DataFrame:
        return products(self.spark, self.data_dir)

    def clickstream(self) -> DataFrame:
        return clickstream(self.spark, self.data_dir)

    def competitor_prices(self) -> DataFrame:
        return competitor_prices(self.spark, self.data_dir)

    def inventory_events(self) -> DataFrame:
        return inventory_events(self.spark, self.data_dir)

    def warehouses(self) -> DataFrame:
        return warehouses(self.spark)
