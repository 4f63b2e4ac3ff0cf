"""Column -> Column helpers shared by the analytics.

Everything here is a built-in Spark expression (JVM-side, codegen'd); no UDFs.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference application's (domain vocabulary,
# thresholds and label texts). Kept together, in natural order.
# ---------------------------------------------------------------------------
EVENT_TYPES = ["page_view", "product_view", "add_to_cart", "remove_from_cart", "purchase"]
FUNNEL_STAGES = ["page_view", "product_view", "add_to_cart", "purchase"]
FUNNEL_LABELS = ["Page View", "Product View", "Add to Cart", "Purchase"]
DEVICES = ["mobile", "desktop", "tablet"]
WAREHOUSES = ["WH-LAGOS", "WH-ABUJA", "WH-PH"]
COMPETITORS = ["TechMart", "GadgetZone", "ElectroHub"]
RECOMMENDATIONS = ["raise", "lower", "hold"]
PRICE_POSITIONS = ["cheaper", "pricier", "competitive"]
SEGMENT_ORDER = ["Champions", "Loyal Customers", "Potential Loyalists", "Big Spenders",
                 "At Risk", "Lost", "Needs Attention"]
DEMAND_HIGH = 5      # purchases in the look-back -> "high demand"
DEMAND_LOW = 2       # purchases in the look-back -> "low demand"
GAP_THRESHOLD_PCT = 10.0
CONFIDENCE_SCALE_PCT = 20.0
PRICE_TARGET_FACTOR = 0.99
CHEAPER_FACTOR = 0.95
PRICIER_FACTOR = 1.05
LOW_STOCK = 20
STOCK_BAND_RED = 10
STOCK_BAND_AMBER = 30
DOW_LABELS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def rnd(c: Column | str, n: int) -> Column:
    """Half-up rounding to ``n`` places, returned as double.

    The value is first normalised to 6 decimals so that binary noise
    (e.g. 868.5*0.99 = 859.8149999999999) rounds the way exact decimal
    arithmetic would, identically in every engine.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("decimal(38,6)"), n).cast("double")


def safe_div(a: Column, b: Column) -> Column:
    """a / b with NULL when b = 0 (SQL ``a / NULLIF(b, 0)``), as double."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def seconds_between(later: Column, earlier: Column) -> Column:
    """EXTRACT(EPOCH FROM later - earlier) as double seconds."""
    return (F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / F.lit(1e6)


def iso_dow(ts: Column) -> Column:
    """ISO day of week, Monday = 1 ... Sunday = 7."""
    return F.weekday(ts) + F.lit(1)


def title_words(c: Column) -> Column:
    """'add_to_cart' -> 'Add To Cart' (str.replace('_', ' ').str.title())."""
    return F.initcap(F.regexp_replace(c, "_", " "))


def recommend(price: Column, avg_comp: Column, velocity: Column,
              high: float = DEMAND_HIGH, low: float = DEMAND_LOW) -> Column:
    """Pricing rule: struct(recommendation, recommended_price, confidence_score).

    gap = (price - avg) / avg * 100
      gap > 10 and velocity < low   -> lower to avg*0.99, confidence min(gap/20, 1)
      gap < -10 and velocity >= high -> raise to avg*0.99, confidence min(|gap|/20, 1)
      otherwise                      -> hold at price,    confidence max(0.5, 1 - |gap|/20)
    """
    p = price.cast("double")
    a = avg_comp.cast("double")
    gap = (p - a) / a * F.lit(100.0)
    is_lower = (gap > GAP_THRESHOLD_PCT) & (velocity < F.lit(low))
    is_raise = (gap < -GAP_THRESHOLD_PCT) & (velocity >= F.lit(high))
    target = rnd(a * F.lit(PRICE_TARGET_FACTOR), 2)
    move_conf = rnd(F.least(F.abs(gap) / F.lit(CONFIDENCE_SCALE_PCT), F.lit(1.0)), 3)
    hold_conf = rnd(F.greatest(F.lit(0.5), F.lit(1.0) - F.abs(gap) / F.lit(CONFIDENCE_SCALE_PCT)), 3)
    rec = F.when(is_lower, "lower").when(is_raise, "raise").otherwise("hold")
    return F.struct(
        rec.alias("recommendation"),
        F.when(is_lower | is_raise, target).otherwise(p).alias("recommended_price"),
        F.when(is_lower | is_raise, move_conf).otherwise(hold_conf).alias("confidence_score"),
    )


def price_position(our: Column, min_comp: Column, max_comp: Column) -> Column:
    """cheaper if our < 0.95*min, pricier if our > 1.05*max, else competitive
    (NULL competitor prices fall through to 'competitive')."""
    o = our.cast("double")
    return (F.when(o < min_comp.cast("double") * F.lit(CHEAPER_FACTOR), "cheaper")
            .when(o > max_comp.cast("double") * F.lit(PRICIER_FACTOR), "pricier")
            .otherwise("competitive"))


def rfm_segment(r: Column, f: Column, m: Column) -> Column:
    """First matching rule wins."""
    return (F.when((r >= 4) & (f >= 4) & (m >= 4), "Champions")
            .when((r >= 3) & (f >= 4), "Loyal Customers")
            .when((r >= 4) & (f <= 2), "Potential Loyalists")
            .when((m >= 4) & (f <= 2), "Big Spenders")
            .when((r <= 2) & (f >= 3), "At Risk")
            .when(r == 1, "Lost")
            .otherwise("Needs Attention"))


def stock_band(stock: Column) -> Column:
    """Dashboard cell band: red < 10, amber < 30, else green."""
    return (F.when(stock < STOCK_BAND_RED, "red")
            .when(stock < STOCK_BAND_AMBER, "amber")
            .otherwise("green"))


def in_list_position(c: Column, values: list[str]) -> Column:
    """1-based position of ``c`` in a fixed list (for categorical ordering)."""
    return F.array_position(F.array(*[F.lit(v) for v in values]), c)
