"""Projections (P1, P9): column selection that tolerates absent columns, and
rounding. Pure ``select``s, so Catalyst prunes the scan to what is used."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_available(df: DataFrame, cols: list[str]) -> tuple[DataFrame, list[str]]:
    """Keep the wanted columns that exist; report the missing ones
    (schema only, no job)."""
    present = [c for c in cols if c in df.columns]
    missing = [c for c in cols if c not in df.columns]
    return df.select(*present), missing


def round_cols(df: DataFrame, cols: list[str], digits: int) -> DataFrame:
    """Round in place (half-up, as SQL ROUND; Python's round is half-even)."""
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])
