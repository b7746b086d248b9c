"""Wide to long, and recoding."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(
    df: DataFrame,
    ids: Sequence[str],
    measures: Sequence[str],
    name: str = "TURNOVER_TYPE",
    value: str = "TURNOVER_RATE_PCT",
    keep_nulls: bool = True,
) -> DataFrame:
    """One row per measure; ``ids`` may be empty."""
    long = df.unpivot(list(ids), list(measures), name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def recode(column: Column, labels: Mapping[str, str]) -> Column:
    """Replace listed values, leave others."""
    result = column
    for old, new in labels.items():
        result = F.when(column == old, F.lit(new)).otherwise(result)
    return result
