"""Registered queries: key -> callable(spark, data_dir) -> DataFrame.

Keys are ``<survey id>_<function>``. Every query reads the given tables (or
data Spark derives from them) in full; parameters that differ from the
reference defaults are the oracle-run parameters (look-backs scaled to the
test data's time span).
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.fixtures import Domain

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Oracle-run parameters (test data spans 30 days of events, years of prices).
DEMAND_LOOKBACK = "7 days"
COMPETITOR_LOOKBACK = "365 days"
QUALITY_AS_OF = "2024-02-01 00:00:00"  # the time of the quality run
STOCKOUT_CRITICAL_H = 3000.0
STOCKOUT_WARNING_H = 9000.0


def register(key: str):
    def deco(fn):
        QUERIES[key] = lambda spark, data_dir, _fn=fn: _fn(Domain(spark, data_dir))
        return fn
    return deco


def recs_of(d: Domain, latest: DataFrame | None = None) -> DataFrame:
    from .plans.pricing import pricing_cycle
    return pricing_cycle(d.products(), d.clickstream(), d.competitor_prices(), lookback=DEMAND_LOOKBACK, latest=latest)


def metrics_of(d: Domain) -> DataFrame:
    from .plans.state import product_metrics
    return product_metrics(d.clickstream(), d.products())


def stock_of(d: Domain) -> DataFrame:
    from .plans.state import inventory_state
    return inventory_state(d.inventory_events(), d.products(), d.warehouses())


from . import queries_core  # noqa: E402,F401  (registers the query functions)
from . import queries_analytics  # noqa: E402,F401
from . import queries_quality  # noqa: E402,F401
from . import queries_streaming  # noqa: E402,F401
from . import queries_primitives  # noqa: E402,F401
from . import queries_extra  # noqa: E402,F401
from . import queries_lake  # noqa: E402,F401
