"""Dashboard scope: one state, one facility, or everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scope_condition(state: str | None = None, ccn: str | None = None) -> Column:
    """``None`` means all. A chosen state never matches a NULL state."""
    inside = F.lit(True)
    if state is not None:
        inside = inside & (F.col("STATE") == state)
    if ccn is not None:
        inside = inside & (F.col("CCN") == ccn)
    return inside


def in_scope(df: DataFrame, state: str | None = None, ccn: str | None = None) -> DataFrame:
    return df if state is None and ccn is None else df.where(scope_condition(state, ccn))
