"""Left join with a dimension when many rows have no key."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 4096


def lookup(df: DataFrame, dim: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """``df`` left joined with ``dim`` on ``key``. Rows with a NULL key meet nothing, but a
    shuffled join would pile them onto one task: a second join column spreads them by a hash
    of the columns ``by``. It is 0 for all other rows."""
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*by), F.lit(SPREAD))).otherwise(F.lit(0)).cast("bigint")
    # a number modulo 1 is 0: a plain literal would be taken out of the join's columns
    zero = F.pmod(F.xxhash64(key), F.lit(1)).cast("bigint")
    return df.withColumn("_spread", spread).join(dim.withColumn("_spread", zero), [key, "_spread"], "left").drop("_spread")
