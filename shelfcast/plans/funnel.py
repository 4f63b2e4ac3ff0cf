"""Conversion-funnel analytics."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import FUNNEL_LABELS, FUNNEL_STAGES, rnd, safe_div, seconds_between, title_words
from ..operators.distinct import distinct_counts
from ..operators.funnel import count_flags, stage_flags, stage_sessions
from ..operators.stats import histogram


def _or_one(c):
    """pandas ``v or 1``: a zero denominator becomes 1."""
    return F.when(c == 0, F.lit(1)).otherwise(c)


def clickstream_overview(ev: DataFrame, approx: bool = False) -> DataFrame:
    """Totals, distinct users / sessions, first and last date, span in seconds
    (``approx`` = HyperLogLog++ distinct counts for very large inputs)."""
    return distinct_counts(
        ev, {"unique_users": "user_id", "unique_sessions": "session_id"},
        F.count(F.lit(1)).alias("total_events"),
        F.to_date(F.min("timestamp")).alias("earliest_date"),
        F.to_date(F.max("timestamp")).alias("latest_date"),
        seconds_between(F.max("timestamp"), F.min("timestamp")).alias("data_span_seconds"),
        approx=approx)


def event_distribution(ev: DataFrame) -> DataFrame:
    """Per event type count, distinct sessions and share of all events.

    The grand total is a one-row aggregate cross-joined back (no global window).
    """
    per = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"),
                                       F.count_distinct("session_id").alias("sessions"))
    total = per.agg(F.sum("event_count").alias("_total"))
    return (per.crossJoin(F.broadcast(total))
               .select("event_type", "event_count", "sessions",
                       rnd(F.col("event_count") * 100.0 / F.col("_total"), 1).alias("pct_of_events")))


def stage_counts(ev: DataFrame) -> DataFrame:
    """One row: distinct sessions reaching each of the four stages."""
    return stage_sessions(ev, [])


def funnel(ev: DataFrame) -> DataFrame:
    """Stage rows with sessions, overall CVR and step CVR (pct, 1 place)."""
    s = stage_counts(ev)
    top = _or_one(F.col(FUNNEL_STAGES[0]))
    rows = []
    for i, (st, label) in enumerate(zip(FUNNEL_STAGES, FUNNEL_LABELS)):
        v = F.col(st)
        step = F.lit(100.0) if i == 0 else rnd(v / _or_one(F.col(FUNNEL_STAGES[i - 1])) * 100.0, 1)
        rows.append(F.struct(F.lit(i + 1).alias("stage_order"), F.lit(label).alias("stage"),
                             v.cast("bigint").alias("sessions"),
                             rnd(v / top * 100.0, 1).alias("overall_cvr_pct"),
                             step.alias("step_cvr_pct")))
    return s.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def funnel_summary(ev: DataFrame) -> DataFrame:
    """U4: view->cart, cart->buy and end-to-end conversion (pct)."""
    s = stage_counts(ev)
    pv, pr, ca, bu = (F.col(c) for c in FUNNEL_STAGES)
    return s.select(rnd(ca / _or_one(pr) * 100.0, 1).alias("product_view_to_cart_pct"),
                    rnd(bu / _or_one(ca) * 100.0, 1).alias("cart_to_purchase_pct"),
                    rnd(bu / _or_one(pv) * 100.0, 2).alias("overall_conversion_pct"))


def funnel_by_device(ev: DataFrame) -> DataFrame:
    """Stage sessions per device with CVRs relative to page-view sessions."""
    f = stage_sessions(ev, ["device_type"])
    base = F.col("page_view")
    return f.select("device_type", *FUNNEL_STAGES,
                    *[rnd(safe_div(F.col(c), base) * 100.0, 1).alias(f"{c}_cvr")
                      for c in ["product_view", "add_to_cart", "purchase"]])


def best_device(by_device: DataFrame) -> DataFrame:
    """The device with the highest purchase CVR (ties: first by name)."""
    d = by_device.filter(F.col("purchase_cvr").isNotNull())
    return d.agg(F.min_by(F.struct("device_type", "purchase_cvr"),
                          F.struct(-F.col("purchase_cvr"), F.col("device_type"))).alias("b")).select("b.*")


def funnel_by_category(ev: DataFrame, products: DataFrame) -> DataFrame:
    """Product-linked stage sessions per category, purchase CVR vs product views.
    The catalogue joins (product, session) flags, not events."""
    stages = ["product_view", "add_to_cart", "purchase"]
    flags = stage_flags(ev.filter(F.col("product_id").isNotNull()), ["product_id"], stages)
    f = count_flags(flags.join(products.select("product_id", "category"), "product_id"), ["category"], stages)
    return f.withColumn("purchase_cvr", rnd(safe_div(F.col("purchase"), F.col("product_view")) * 100.0, 1))


def funnel_long(by_category: DataFrame) -> DataFrame:
    """Melt the category funnel to (category, stage, sessions), stage title-cased."""
    long = by_category.unpivot("category", ["product_view", "add_to_cart", "purchase"], "stage", "sessions")
    return long.select("category", title_words(F.col("stage")).alias("stage"), "sessions")


def hourly_activity(ev: DataFrame) -> DataFrame:
    """Events per (hour of day, event type)."""
    return ev.groupBy(F.hour("timestamp").cast("int").alias("hour"), "event_type").agg(
        F.count(F.lit(1)).alias("event_count"))


def peak_purchase_hours(ev: DataFrame, k: int = 3) -> DataFrame:
    """The k hours of day with most purchases (ties: earlier hour)."""
    h = hourly_activity(ev.filter(F.col("event_type") == "purchase"))
    return h.orderBy(F.desc("event_count"), F.asc("hour")).limit(k).select("hour", "event_count")


def sessions(ev: DataFrame) -> DataFrame:
    """U8: one row per (session, device) with size, span and outcome."""
    return ev.groupBy("session_id", "device_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        F.count_distinct("event_type").alias("distinct_event_types"),
        F.min("timestamp").alias("session_start"),
        F.max("timestamp").alias("session_end"),
        rnd(seconds_between(F.max("timestamp"), F.min("timestamp")) / 60.0, 2).alias("duration_min"),
        F.bool_or(F.col("event_type") == "purchase").alias("converted"),
    )


def session_totals(sess: DataFrame) -> DataFrame:
    """Sessions, converted, conversion pct, mean events and duration."""
    return sess.agg(
        F.count(F.lit(1)).alias("total_sessions"),
        F.count_if("converted").alias("converted_sessions"),
        rnd(safe_div(F.count_if("converted"), F.count(F.lit(1))) * 100.0, 2).alias("conversion_rate_pct"),
        rnd(F.avg("event_count"), 2).alias("avg_events"),
        rnd(F.avg("duration_min"), 2).alias("avg_duration_min"),
    )


def _outcome(c):
    return F.when(c, "Converted").otherwise("Not Converted")


def session_outcome_summary(sess: DataFrame) -> DataFrame:
    """Converted vs not converted profile."""
    return sess.groupBy(_outcome(F.col("converted")).alias("outcome")).agg(
        F.count(F.lit(1)).alias("sessions"),
        rnd(F.avg("event_count"), 2).alias("avg_events"),
        rnd(F.avg("duration_min"), 2).alias("avg_duration_min"),
        rnd(F.avg("distinct_event_types"), 2).alias("avg_distinct_types"),
    )


def session_cvr_by_device(sess: DataFrame) -> DataFrame:
    """Session conversion per device."""
    return sess.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("total"), F.count_if("converted").alias("converted"),
    ).withColumn("cvr", rnd(F.col("converted") / F.col("total") * 100.0, 1))


def session_event_histogram(sess: DataFrame, n_bins: int = 25) -> DataFrame:
    """Events-per-session histogram by outcome."""
    s = sess.withColumn("outcome", _outcome(F.col("converted")))
    return histogram(s, ["outcome"], "event_count", n_bins)
