"""Small DataFrame helpers: renamed report headings (P10), ordered top-n."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rename_columns(df: DataFrame, mapping: dict) -> DataFrame:
    """P10: output columns under report headings (any language)."""
    return df.withColumnsRenamed(mapping)


def top_n(df: DataFrame, n: int, *order) -> DataFrame:
    """The reference takes TOP n without ORDER BY (arbitrary rows); here
    an order is required so the result repeats. Only for reports whose
    feature is a bounded sample."""
    if not order:
        raise ValueError("top_n needs an order")
    return df.orderBy(*order).limit(n)
