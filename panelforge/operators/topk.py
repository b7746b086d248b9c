"""First row per key and top-N."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tie_columns(df: DataFrame, used: Sequence[str]) -> list[Column]:
    """The columns not in ``used``, ascending, to make an order repeatable."""
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c not in used]


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    ties: Sequence[Column] | None = None,
) -> DataFrame:
    """Keep one row per key, the first in ``order``.

    Rows equal under ``order`` are settled by the remaining columns. Catalyst turns the
    ``== 1`` filter into a group limit on both sides of the exchange, so each map task
    ships at most one row per key however many rows the key has.
    """
    ties = tie_columns(df, keys) if ties is None else list(ties)
    ranking = [*order, *ties] or [F.col(f"`{keys[0]}`")]
    window = Window.partitionBy(*keys).orderBy(*ranking)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)
