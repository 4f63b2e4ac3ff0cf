"""Tables by day as published generations: marts refreshed by the days that changed
(S13, X2, X3) and the lake's small files compacted (S9, S12, T10)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .plans import marts
from .queries_extra import _mart_ctes, _run_dir, reg
from .sources.generations import DayTable, refresh

RECENT = "7 days"  # what the second delivery brings; it begins within a day that the first has


def _deliveries(df: DataFrame, unit: str = "day") -> list[DataFrame]:
    """All rows in two deliveries by time, as rows of a table by date (a month's first)."""
    dated = df.withColumn("date", F.date_trunc(unit, "timestamp").cast("date"))
    cut = df.agg(F.max("timestamp") - F.expr(f"INTERVAL '{RECENT}'")).scalar()
    late = F.coalesce(F.col("timestamp") >= cut, F.lit(False))
    return [dated.where(~late), dated.where(late)]


def _hourly(products: DataFrame):
    return lambda ev: marts.hourly_demand(ev, products).withColumn("date", F.to_date("hour_bucket"))


def _funnel(products: DataFrame):
    return lambda ev: marts.daily_funnel_metrics(ev, products)


def _refreshed(d, key: str, build, day: str) -> DataFrame:
    """The mart after a delivery, a refresh, a second delivery and a refresh of its days."""
    base, products = _run_dir(d, key), d.products().select("product_id", "category")
    log, mart = DayTable(d.spark, base + "/events"), DayTable(d.spark, base + "/mart", day)
    for rows in _deliveries(d.clickstream()):
        log.append(rows)
        refresh(log, mart, build(products), products)
    return mart.read()


@reg("x2_incremental_hourly_demand", "SELECT * FROM hourly_demand", _mart_ctes())
def _x2_incremental(d):
    return _refreshed(d, "x2i", _hourly, "date").drop("date")


@reg("x3_incremental_daily_funnel", "SELECT * FROM daily_funnel_metrics", _mart_ctes())
def _x3_incremental(d):
    return _refreshed(d, "x3i", _funnel, "day")


@reg("s13_incremental_refresh", f"""
WITH days AS (SELECT CAST(timestamp AS DATE) AS day, timestamp >= (SELECT max(timestamp) FROM clickstream) - INTERVAL '{RECENT}' AS late
              FROM clickstream),
counts AS (SELECT count(DISTINCT day) FILTER (WHERE NOT late) AS n1, count(DISTINCT day) FILTER (WHERE late) AS n2 FROM days),
totals AS (SELECT 'hourly_demand' AS mart, count(DISTINCT CAST(hour_bucket AS DATE)) AS n_days, count(*) AS n_rows FROM hourly_demand
           UNION ALL SELECT 'daily_funnel_metrics', count(DISTINCT day), count(*) FROM daily_funnel_metrics)
SELECT mart, n1 AS first_days, n2 AS second_days, CAST(0 AS BIGINT) AS after_compaction,
       (SELECT count(DISTINCT day) FROM days) AS after_new_catalogue, n_days, n_rows
FROM totals, counts""", _mart_ctes())
def _s13_incremental(d):
    """Days built by four refreshes of two marts: after each of two deliveries, after the
    log was compacted (none) and after the catalogue changed (all)."""
    base, products = _run_dir(d, "s13i"), d.products().select("product_id", "category")
    log = DayTable(d.spark, base + "/events")
    tables = {"hourly_demand": (DayTable(d.spark, base + "/hourly"), _hourly),
              "daily_funnel_metrics": (DayTable(d.spark, base + "/funnel", "day"), _funnel)}
    built = {name: [] for name in tables}

    def refresh_all(dim):
        for name, (mart, build) in tables.items():
            built[name].append(len(refresh(log, mart, build(dim), dim)))
    for rows in _deliveries(d.clickstream()):
        log.append(rows)
        refresh_all(products)
    log.compact()
    refresh_all(products)
    renamed = products.withColumn("category", F.lower("category"))
    refresh_all(renamed)
    rows = [(name, *built[name], len(mart.manifest()["days"]), mart.read().count()) for name, (mart, _) in tables.items()]
    return d.spark.createDataFrame(rows, "mart string, first_days bigint, second_days bigint, after_compaction bigint, "
                                         "after_new_catalogue bigint, n_days bigint, n_rows bigint")


# Stock and price events are few a day over years, so their folders are months.
UNITS = {"clickstream": "day", "inventory_events": "month", "competitor_prices": "month"}


def _dates(table: str) -> str:
    return f"""SELECT '{table}' AS "table", CAST(date_trunc('{UNITS[table]}', timestamp) AS DATE) AS date, count(*) AS n_rows,
       CAST(bool_or(NOT late) AS BIGINT) + CAST(bool_or(late) AS BIGINT) AS versions_before, CAST(1 AS BIGINT) AS versions_after
FROM (SELECT timestamp, timestamp >= max(timestamp) OVER () - INTERVAL '{RECENT}' AS late FROM {table}) GROUP BY 2"""


@reg("s12_compacted_lake", " UNION ALL ".join(map(_dates, UNITS)))
def _s12_compacted(d):
    """Three tables of the lake in two deliveries each, compacted: rows of each folder, read
    from the compacted generation, and the versions that it lay in before and lies in now."""
    base, out = _run_dir(d, "s12c"), None
    for name, unit in UNITS.items():
        table = DayTable(d.spark, f"{base}/{name}")
        for rows in _deliveries(getattr(d, name)(), unit):
            table.append(rows)
        before = table.manifest()["days"]
        table.compact()
        after = table.manifest()["days"]
        # a line a folder of the table
        versions = d.spark.createDataFrame([(day, len(before[day]["versions"]), len(e["versions"])) for day, e in after.items()],
                                           "day string, versions_before bigint, versions_after bigint")
        one = (table.read().groupBy("date").agg(F.count(F.lit(1)).alias("n_rows"))
               .join(versions, F.col("date").cast("string") == F.col("day"))
               .select(F.lit(name).alias("table"), "date", "n_rows", "versions_before", "versions_after"))
        out = one if out is None else out.unionByName(one)
    return out
