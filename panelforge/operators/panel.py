"""Latest snapshot, lookback window and exact-snapshot filters."""

from __future__ import annotations

import calendar
import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.measures import month_start

DEFAULT_LOOKBACK_MONTHS = 12


def latest_snapshot(panel: DataFrame, column: str = "SNAPSHOT_DATE") -> datetime.date:
    """The newest snapshot date; a panel without any is an error.

    One scalar comes back to the driver on purpose: as a literal it prunes date
    partitions and Parquet row groups in every query that uses it, which a subquery
    result does not.
    """
    latest = panel.agg(F.max(column)).first()[0]
    if latest is None:
        raise ValueError(f"no valid {column} in the panel")
    return latest


def lookback_start(
    latest: datetime.date, months: int = DEFAULT_LOOKBACK_MONTHS
) -> datetime.date:
    """``add_months(latest, 1 - months)``: a day the month lacks becomes its last day."""
    at = latest.year * 12 + latest.month - months
    year, month = at // 12, at % 12 + 1
    day = min(latest.day, calendar.monthrange(year, month)[1])
    return datetime.date(year, month, day)


def lookback(
    panel: DataFrame,
    latest: datetime.date,
    months: int = DEFAULT_LOOKBACK_MONTHS,
    column: str = "SNAPSHOT_DATE",
) -> DataFrame:
    """Rows of the last ``months`` months up to ``latest``, with their MONTH."""
    first = lookback_start(latest, months)
    return panel.where(F.col(column) >= F.lit(first)).withColumn("MONTH", month_start(F.col(column)))


def at_snapshot(
    panel: DataFrame, latest: datetime.date, column: str = "SNAPSHOT_DATE"
) -> DataFrame:
    return panel.where(F.col(column) == F.lit(latest))
