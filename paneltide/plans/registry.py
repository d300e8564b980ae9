"""Imports every query module so that all queries are registered."""

from paneltide.plans import queries, queries_products, queries_quality, queries_timeseries, queries_causal  # noqa: F401
