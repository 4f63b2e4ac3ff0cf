"""Declarative data-quality rules (Q1-Q19).

A rule is (group, name, table, metric, comparison, expected). ``run_rules``
evaluates all rules that read the same table in ONE aggregation over it (every
metric is a column of a single ``agg``), then turns the one-row results into
rule rows with ``inline``. A staged view and the orphans of a table are ``Part``s of
it and are counted in its scan; rules about duplicate keys read a keyed count.
"""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import COMPETITORS, DEVICES, EVENT_TYPES, PRICE_POSITIONS, RECOMMENDATIONS, WAREHOUSES
from ..operators.lookup import lookup
from ..session import materialize

# Fixed limits from the reference rules.
MAX_STOCK_PER_SLOT = 100_000
MAX_ABS_PRICE_DIFF_PCT = 80
FUTURE_TOLERANCE = "5 minutes"


@dataclass(frozen=True)
class Rule:
    group: str
    name: str
    table: str            # key into the tables dict given to run_rules
    metric: Callable[[], Column]   # aggregate expression over the table
    comparison: str       # 'eq' | 'le' | 'ge'
    expected: Callable[[], Column] | int


@dataclass(frozen=True)
class Part:
    """A table that is all rows of the table ``of``, or those ``where`` a condition holds
    (rules on it can only count rows then): its rules are evaluated in the scan of ``of``."""
    of: str
    where: Callable[[], Column] | None = None


# What ``detail`` writes between the value found and the one expected.
SIGNS = {"eq": "against exactly", "le": "against at most", "ge": "against at least"}


def _cmp(v: Column, op: str, e: Column) -> Column:
    return {"eq": v == e, "le": v <= e, "ge": v >= e}[op]


def run_rules(tables: dict, rules: Sequence[Rule]) -> DataFrame:
    """Evaluate ``rules`` (tables may be DataFrames or zero-argument builders,
    so only the tables a rule set reads are planned); one row per rule:
    (rule_group, rule_name, value, expected, comparison, passed, detail)."""
    def home(r: Rule) -> str:
        t = tables[r.table]
        return t.of if isinstance(t, Part) else r.table

    def metric(r: Rule) -> Column:
        t = tables[r.table]
        if not isinstance(t, Part) or t.where is None:
            return r.metric()
        if r.metric is not _count:
            raise ValueError(f"rule {r.name}: only rows of {r.table} can be counted")
        return F.count_if(t.where())

    out = None
    for tname in dict.fromkeys(map(home, rules)):
        rs = [r for r in rules if home(r) == tname]
        metrics = [metric(r).cast("bigint").alias(f"m{i}") for i, r in enumerate(rs)]
        t = tables[tname]
        one = (t() if callable(t) else t).agg(*metrics)
        rows = []
        for i, r in enumerate(rs):
            e = r.expected() if callable(r.expected) else F.lit(r.expected)
            v, e = F.col(f"m{i}"), e.cast("bigint")
            rows.append(F.struct(F.lit(r.group).alias("rule_group"), F.lit(r.name).alias("rule_name"),
                                 v.alias("value"), e.alias("expected"),
                                 F.lit(r.comparison).alias("comparison"),
                                 F.coalesce(_cmp(v, r.comparison, e), F.lit(False)).alias("passed"),
                                 F.concat_ws(" ", v, F.lit(SIGNS[r.comparison]), e).alias("detail")))
        part = one.select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


def summarize(report: DataFrame) -> DataFrame:
    """Q19: per group and overall ('ALL') totals of passed / failed rules. The report is
    written first (a row a rule): both totals read it, and it is dear to evaluate."""
    report = materialize(report, "quality-report")
    per = report.groupBy("rule_group").agg(F.count(F.lit(1)).alias("rules"),
                                           F.count_if("passed").alias("passed"),
                                           F.count_if(~F.col("passed")).alias("failed"))
    tot = report.agg(F.lit("ALL").alias("rule_group"), F.count(F.lit(1)).alias("rules"),
                     F.count_if("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed"))
    return per.unionByName(tot)


def _count() -> Column:
    return F.count(F.lit(1))


def not_null_rules(group: str, table: str, cols: Sequence[str]) -> list[Rule]:
    """Q15: dbt not_null (all columns in one pass)."""
    return [Rule(group, f"not_null {table}.{c}", table, lambda c=c: F.count_if(F.col(c).isNull()), "eq", 0)
            for c in cols]


def accepted_rule(group: str, table: str, col: str, values: Sequence[str], where: Column | None = None) -> Rule:
    """Q17: dbt accepted_values (NULLs are not checked, optional row filter)."""
    def m(col=col, values=tuple(values), where=where):
        bad = F.col(col).isNotNull() & ~F.col(col).isin(*values)
        return F.count_if(bad & where) if where is not None else F.count_if(bad)
    return Rule(group, f"accepted_values {table}.{col}", table, m, "eq", 0)


def unique_table(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Q16 helper: one row per duplicated key value."""
    return df.groupBy(*keys).agg(_count().alias("_n")).filter(F.col("_n") > 1)


def orphans(df: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Q6/Q14 helper: rows whose non-NULL product reference is unknown (anti join)."""
    return df.filter(F.col(key).isNotNull()).join(products.select(key), key, "left_anti")


def known_products(df: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """``df`` and whether a row's product reference is unknown (``_orphan``; a NULL one is not)."""
    known = products.where(F.col(key).isNotNull()).select(key).distinct().withColumn("_known", F.lit(True))
    return lookup(df, known, key, [c for c in df.columns if c != key]).withColumn(
        "_orphan", F.col(key).isNotNull() & F.col("_known").isNull()).drop("_known")


def quality_tables(products, stock, ev, inv, cp, recs, stg_clickstream, stg_inventory, stg_cp,
                   daily_funnel, product_perf, pricing, hourly) -> dict:
    """Name -> table; every argument is a zero-argument builder. ``ev``, ``inv`` (inventory
    events), ``cp``, ``stock`` and ``recs`` are scanned once for their own rules, those of
    their staged view and their orphans, and once more where a key must be unique."""
    orphan = lambda: F.col("_orphan")
    return {
        "products": products,
        "inventory_state": lambda: known_products(stock(), products()),
        "clickstream_events": lambda: known_products(
            stg_clickstream(ev()).withColumn("timestamp", F.col("event_timestamp")), products()),
        "inventory_events": lambda: known_products(stg_inventory(inv()), products()),
        "competitor_prices": lambda: known_products(cp(), products()),
        "pricing_recommendations": lambda: known_products(recs(), products()),
        "stg_clickstream": Part("clickstream_events"), "stg_inventory": Part("inventory_events"),
        "orphan_events": Part("clickstream_events", orphan),
        "orphan_recommendations": Part("pricing_recommendations", orphan),
        "orphan_stock": Part("inventory_state", orphan),
        "orphan_inventory": Part("inventory_events", orphan),
        "orphan_competitor_prices": Part("competitor_prices", orphan),
        "stg_competitor_prices": lambda: stg_cp(cp()),
        "daily_funnel_metrics": daily_funnel, "product_performance": product_perf,
        "pricing_analysis": pricing, "hourly_demand": hourly,
        "dup_stg_clickstream": lambda: unique_table(ev(), ["event_id"]),
        "dup_stg_inventory": lambda: unique_table(inv(), ["event_id"]),
        "dup_product_performance": lambda: unique_table(product_perf(), ["product_id"]),
        "dup_pricing_analysis": lambda: unique_table(pricing(), ["product_id"]),
    }


def default_rules(n_products: Callable[[], Column], n_warehouses: int = len(WAREHOUSES),
                  as_of: Callable[[], Column] | None = None) -> list[Rule]:
    """The reference's 13 assertions, the dbt schema tests and the DDL checks."""
    ts_limit = (lambda: as_of() + F.expr(f"INTERVAL '{FUTURE_TOLERANCE}'")) if as_of else None
    rules = [
        # Q2-Q4 inventory
        Rule("Inventory", "no_negative_stock", "inventory_state",
             lambda: F.count_if(F.col("current_stock") < 0), "eq", 0),
        Rule("Inventory", "inventory_row_count", "inventory_state", _count, "eq",
             lambda: n_products() * F.lit(n_warehouses)),
        Rule("Inventory", "max_stock", "inventory_state",
             lambda: F.coalesce(F.max("current_stock"), F.lit(0)), "le", MAX_STOCK_PER_SLOT),
        # Q5-Q8 clickstream
        Rule("Clickstream", "valid_event_types", "clickstream_events",
             lambda: F.count_if(~F.col("event_type").isin(*EVENT_TYPES)), "eq", 0),
        Rule("Clickstream", "no_orphan_events", "orphan_events", _count, "eq", 0),
        Rule("Clickstream", "table_not_empty", "clickstream_events", _count, "ge", 1),
        # Q9-Q11 competitor prices
        Rule("Competitor Prices", "positive_competitor_prices", "competitor_prices",
             lambda: F.count_if(F.col("competitor_price") <= 0), "eq", 0),
        Rule("Competitor Prices", "price_diff_within_80pct", "competitor_prices",
             lambda: F.count_if((F.col("price_difference_pct") < -MAX_ABS_PRICE_DIFF_PCT)
                                | (F.col("price_difference_pct") > MAX_ABS_PRICE_DIFF_PCT)), "eq", 0),
        Rule("Competitor Prices", "known_competitors", "competitor_prices",
             lambda: F.count_if(~F.col("competitor_name").isin(*COMPETITORS)), "eq", 0),
        # Q12-Q14 recommendations
        Rule("Pricing Recommendations", "valid_recommendations", "pricing_recommendations",
             lambda: F.count_if(~F.col("recommendation").isin(*RECOMMENDATIONS)), "eq", 0),
        Rule("Pricing Recommendations", "confidence_in_range", "pricing_recommendations",
             lambda: F.count_if((F.col("confidence_score") < 0) | (F.col("confidence_score") > 1)), "eq", 0),
        Rule("Pricing Recommendations", "no_orphan_recommendations",
             "orphan_recommendations", _count, "eq", 0),
        # Q18 DDL checks
        Rule("Constraints", "products.base_price > 0", "products",
             lambda: F.count_if(F.col("base_price") <= 0), "eq", 0),
        Rule("Constraints", "pricing_recommendations.recommended_price > 0", "pricing_recommendations",
             lambda: F.count_if(F.col("recommended_price") <= 0), "eq", 0),
        Rule("Constraints", "pricing_recommendations.confidence_score in [0, 1]", "pricing_recommendations",
             lambda: F.count_if(~F.col("confidence_score").between(0, 1)), "eq", 0),
        Rule("Constraints", "foreign key inventory_state.product_id", "orphan_stock", _count, "eq", 0),
        Rule("Constraints", "foreign key inventory_events.product_id", "orphan_inventory", _count, "eq", 0),
        Rule("Constraints", "foreign key competitor_prices.product_id", "orphan_competitor_prices", _count, "eq", 0),
    ]
    if ts_limit is not None:
        rules.insert(5, Rule("Clickstream", "no_future_timestamps", "clickstream_events",
                             lambda: F.count_if(F.col("timestamp") > ts_limit()), "eq", 0))
    # Q15-Q17 schema tests
    rules += not_null_rules("Schema", "stg_clickstream",
                            ["event_id", "user_id", "session_id", "event_type", "device_type", "event_timestamp",
                             "hour_of_day", "day_of_week"])
    rules += not_null_rules("Schema", "stg_inventory",
                            ["event_id", "product_id", "warehouse_id", "event_type", "quantity_change",
                             "event_timestamp", "absolute_quantity"])
    rules += not_null_rules("Schema", "stg_competitor_prices",
                            ["product_id", "competitor_name", "competitor_price", "observed_at", "our_price"])
    rules += not_null_rules("Schema", "daily_funnel_metrics", ["day", "category"])
    rules += not_null_rules("Schema", "hourly_demand", ["hour_bucket", "category"])
    rules += not_null_rules("Schema", "product_performance", ["product_id", "product_name", "category"])
    rules += not_null_rules("Schema", "pricing_analysis", ["product_id", "price_position", "our_price"])
    rules += [
        Rule("Schema", "unique stg_clickstream.event_id", "dup_stg_clickstream", _count, "eq", 0),
        Rule("Schema", "unique stg_inventory.event_id", "dup_stg_inventory", _count, "eq", 0),
        Rule("Schema", "unique product_performance.product_id", "dup_product_performance", _count, "eq", 0),
        Rule("Schema", "unique pricing_analysis.product_id", "dup_pricing_analysis", _count, "eq", 0),
        accepted_rule("Schema", "stg_clickstream", "event_type", EVENT_TYPES),
        accepted_rule("Schema", "stg_clickstream", "device_type", DEVICES),
        accepted_rule("Schema", "stg_inventory", "warehouse_id", WAREHOUSES),
        accepted_rule("Schema", "stg_competitor_prices", "competitor_name", COMPETITORS),
        accepted_rule("Schema", "pricing_analysis", "price_position", PRICE_POSITIONS),
        accepted_rule("Schema", "pricing_analysis", "recommendation", RECOMMENDATIONS,
                      where=F.col("recommendation").isNotNull()),
    ]
    return rules
