"""Query registrations for funnel, RFM, demand, elasticity and dashboard analytics."""
from __future__ import annotations

from pyspark.sql import functions as F

from .plans import dashboard as B
from .plans import demand as G
from .plans import elasticity as K
from .plans import funnel as U
from .plans import rfm as RF
from .registry import (STOCKOUT_CRITICAL_H, STOCKOUT_WARNING_H, metrics_of, recs_of, register, stock_of)


def _reg(key, fn):
    register(key)(fn)


# --- funnel -----------------------------------------------------------------
_reg("u1_clickstream_overview", lambda d: U.clickstream_overview(d.clickstream()))
_reg("u2_event_distribution", lambda d: U.event_distribution(d.clickstream()))
_reg("u3_funnel", lambda d: U.funnel(d.clickstream()))
_reg("u4_funnel_summary", lambda d: U.funnel_summary(d.clickstream()))
_reg("u5_funnel_by_device", lambda d: U.funnel_by_device(d.clickstream()))
_reg("u5_best_device", lambda d: U.best_device(U.funnel_by_device(d.clickstream())))
_reg("u6_funnel_by_category", lambda d: U.funnel_by_category(d.clickstream(), d.products()))
_reg("u6_funnel_long", lambda d: U.funnel_long(U.funnel_by_category(d.clickstream(), d.products())))
_reg("u7_hourly_activity", lambda d: U.hourly_activity(d.clickstream()))
_reg("u7_peak_purchase_hours", lambda d: U.peak_purchase_hours(d.clickstream(), 3))
_reg("u8_sessions", lambda d: U.sessions(d.clickstream()))
_reg("u9_session_totals", lambda d: U.session_totals(U.sessions(d.clickstream())))
_reg("u10_session_outcome_summary", lambda d: U.session_outcome_summary(U.sessions(d.clickstream())))
_reg("u11_session_cvr_by_device", lambda d: U.session_cvr_by_device(U.sessions(d.clickstream())))
_reg("u12_session_event_histogram", lambda d: U.session_event_histogram(U.sessions(d.clickstream()), 25))

# --- RFM --------------------------------------------------------------------


def _scores(d):
    return RF.rfm_scores(RF.rfm_raw(d.clickstream()))


_reg("r1_purchase_overview", lambda d: RF.purchase_overview(d.clickstream()))
_reg("r2_purchases_per_user", lambda d: RF.purchases_per_user(d.clickstream()))
_reg("r2_purchase_histogram", lambda d: RF.purchase_histogram(d.clickstream(), 30))
_reg("r3_rfm_raw", lambda d: RF.rfm_raw(d.clickstream()))
_reg("r3_rfm_describe", lambda d: RF.rfm_describe(RF.rfm_raw(d.clickstream())))
_reg("r4_rfm_scores", _scores)
_reg("r5_rfm_segment", lambda d: _scores(d).select("user_id", "R", "F", "M", "segment"))
_reg("r6_rf_matrix", lambda d: RF.rf_matrix(_scores(d)))
_reg("r7_segment_sizes", lambda d: RF.segment_sizes(_scores(d)))
_reg("r8_segment_revenue", lambda d: RF.segment_revenue(_scores(d)))
_reg("r9_segment_profiles", lambda d: RF.segment_profiles(_scores(d)))
_reg("r10_preferred_device", lambda d: RF.preferred_device(d.clickstream(), _scores(d)))
_reg("r10_device_by_segment", lambda d: RF.device_by_segment(RF.preferred_device(d.clickstream(), _scores(d))))
_reg("r11_device_share",
     lambda d: RF.device_share(RF.device_by_segment(RF.preferred_device(d.clickstream(), _scores(d)))))

# --- demand & inventory -----------------------------------------------------


def _hourly(d):
    return G.hourly_category_demand(d.clickstream(), d.products())


def _horizon(d):
    return G.stockout_horizon(G.stock_and_rate(stock_of(d), d.clickstream(), d.products()),
                              STOCKOUT_CRITICAL_H, STOCKOUT_WARNING_H)


_reg("g1_demand_overview", lambda d: G.demand_overview(d.clickstream()))
_reg("g2_daily_purchases", lambda d: G.daily_purchases(d.clickstream()))
_reg("g3_hourly_category_demand", _hourly)
_reg("g4_category_totals", lambda d: G.category_totals(_hourly(d)))
_reg("g5_moving_averages", lambda d: G.moving_averages(d.clickstream()))
_reg("g5_series_stats", lambda d: G.series_stats(d.clickstream()))
_reg("g6_demand_heatmap", lambda d: G.demand_heatmap(d.clickstream()))
_reg("g6_heatmap_wide", lambda d: G.heatmap_wide(G.demand_heatmap(d.clickstream())))
_reg("g7_peak_slots", lambda d: G.peak_slots(d.clickstream(), 5))
_reg("g8_category_ranking", lambda d: G.category_ranking(_hourly(d)))
_reg("g9_demand_forecast", lambda d: G.demand_forecast(_hourly(d)))
_reg("g10_stock_and_rate", lambda d: G.stock_and_rate(stock_of(d), d.clickstream(), d.products()))
_reg("g11_stockout_horizon", _horizon)
_reg("g11_at_risk", lambda d: G.at_risk(_horizon(d)))
_reg("g11_status_counts", lambda d: G.status_counts(_horizon(d)))

# --- price elasticity -------------------------------------------------------


def _gaps(d):
    return K.price_gaps(d.competitor_prices(), d.products())


def _land(d):
    return K.competitor_landscape(d.competitor_prices(), d.products())


def _sim(d):
    return K.revenue_simulation(recs_of(d), d.products(), metrics_of(d))


_reg("k1_price_overview", lambda d: K.price_overview(d.competitor_prices(), recs_of(d)))
_reg("k2_category_price_position", lambda d: K.category_price_position(recs_of(d), d.products()))
_reg("k3_price_position", lambda d: K.price_position(recs_of(d), d.products()))
_reg("k4_above_below_par", lambda d: K.above_below_par(K.price_position(recs_of(d), d.products())))
_reg("k5_price_gaps", lambda d: _gaps(d).drop("obs_key"))
_reg("k5_gap_describe", lambda d: K.gap_describe(_gaps(d)))
_reg("k5_gap_histogram", lambda d: K.gap_histogram(_gaps(d), 40))
_reg("k5_gap_box", lambda d: K.gap_box(_gaps(d)))
_reg("k6_recommendation_table", lambda d: K.recommendation_table(recs_of(d)))
_reg("k7_recommendation_split", lambda d: K.recommendation_split(recs_of(d)))
_reg("k8_competitor_landscape", _land)
_reg("k9_undercut_summary", lambda d: K.undercut_summary(_land(d)))
_reg("k10_undercut_matrix_product", lambda d: K.undercut_matrix(_land(d), "product_name"))
_reg("k10_undercut_matrix_category", lambda d: K.undercut_matrix(_land(d), "category"))
_reg("k11_revenue_simulation", _sim)
_reg("k11_simulation_total", lambda d: K.simulation_total(_sim(d)))

# --- dashboard --------------------------------------------------------------
_reg("b1_overview_kpis", lambda d: B.overview_kpis(metrics_of(d), d.products()))
_reg("b2_top_products_by_revenue", lambda d: B.top_products_by_revenue(metrics_of(d), d.products(), 10))
_reg("b3_latest_recommendations", lambda d: B.latest_recommendations(recs_of(d), 10))
_reg("b4_inventory_kpis", lambda d: B.inventory_kpis(stock_of(d)))
_reg("b5_stock_by_warehouse", lambda d: B.stock_by_warehouse(d.products(), stock_of(d)))
_reg("b6_stock_band", lambda d: B.stock_bands(B.stock_by_warehouse(d.products(), stock_of(d))))
_reg("b7_stock_by_category", lambda d: B.stock_by_category(d.products(), stock_of(d)))
_reg("b8_recommendation_kpis", lambda d: B.recommendation_kpis(recs_of(d)))
_reg("b9_all_latest_recommendations", lambda d: B.all_latest_recommendations(recs_of(d)))
_reg("b10_price_vs_velocity", lambda d: B.price_vs_velocity(recs_of(d)))
_reg("b11_latest_events", lambda d: B.latest_events(d.clickstream(), d.products(), 50))
_reg("b12_event_type_counts", lambda d: B.event_type_counts(d.clickstream()))
_reg("b12_device_counts", lambda d: B.device_counts(d.clickstream()))
