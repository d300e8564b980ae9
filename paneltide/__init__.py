"""paneltide: panel analytics (entity x time tables) as lazy Spark DataFrame plans.

Layout
------
sources/    landing, snapshots, contracts, format dispatch (S1-S11)
functions/  column expressions: flags, shares, labels, money sums (P*)
operators/  filters, joins, aggregates, windows, ranking, quality,
            metrics, forecasting, anomaly and causal estimators
plans/      composed layers (silver, gold, marts), the proxy panels built
            from the driver tables, and the query catalogue
streaming/  incremental landing of snapshot files with Structured Streaming
"""

__version__ = "0.1.0"
