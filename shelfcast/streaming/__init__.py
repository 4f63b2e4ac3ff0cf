from .jobs import (  # noqa: F401
    Snapshot, additive_sink, clickstream_fanout, dedup, event_time, stock_sink, latest_competitor_prices,
    pricing_trigger, running_product_metrics, start, throughput, upsert_sink,
)
