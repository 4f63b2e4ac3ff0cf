"""shelfcast: retail pricing & inventory analytics as Spark DataFrame programs.

Sub-packages:
  sources    table scans, testdata fixtures, stream sources, the Parquet lake
  functions  Column -> Column helpers (labels, rounding, pricing rule)
  operators  reusable DataFrame -> DataFrame operators (latest-by, funnels,
             exact ranks/quantiles, histograms, ordered folds, upserts)
  plans      the user-facing analytics (marts, pricing, funnel, RFM, demand,
             elasticity, dashboard queries, data quality)
  streaming  Structured Streaming jobs (ingest, state, pricing trigger, lake)
"""

__version__ = "0.1.0"
