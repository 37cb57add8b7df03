"""List columns to rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def explode_items(df: DataFrame, keep, array, name: str) -> DataFrame:
    """One row per non-null array element.

    The outer form plus a filter on the element: for a plain explode the optimizer
    adds a "not empty" filter that evaluates a computed array a second time.
    """
    out = df.select(*keep, F.explode_outer(array).alias(name))
    return out.filter(F.col(name).isNotNull())
