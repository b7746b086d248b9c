"""Correlation, z-scores, linear fit and histogram as aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.operators.joins import attach_constant


def pearson(x: Column, y: Column) -> Column:
    """Pearson correlation of the complete pairs; NULL for one pair or no variance.

    The built-in ``corr`` divides by zero under ANSI when a side is constant.
    """
    paired_x = F.when(y.isNotNull(), x)
    paired_y = F.when(x.isNotNull(), y)
    spread = F.stddev_pop(paired_x) * F.stddev_pop(paired_y)
    return F.try_divide(F.covar_pop(x, y), spread)


def correlate(
    df: DataFrame, keys: Sequence[str], x: str, y: str, value_name: str, count_name: str
) -> DataFrame:
    """Correlation and row count per key (one row overall when ``keys`` is empty)."""
    return df.groupBy(*keys).agg(
        pearson(F.col(x), F.col(y)).alias(value_name), F.count(F.lit(1)).alias(count_name)
    )


def group_means(df: DataFrame, key: str, measures: dict[str, str]) -> DataFrame:
    """Mean of each source column per non-NULL key; ``measures`` maps output to source."""
    means = (F.avg(source).alias(name) for name, source in measures.items())
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(*means)


def z_scores(table: DataFrame, columns: Sequence[str], suffix: str = "_Z") -> DataFrame:
    """Population z-score of each column over all rows; 0 when the spread is zero or NULL."""
    moments = table.agg(
        *(F.avg(c).alias(f"_mean_{c}") for c in columns),
        *(F.stddev_pop(c).alias(f"_sd_{c}") for c in columns),
    )

    def scored(c: str) -> Column:
        mean, sd = F.col(f"_mean_{c}"), F.col(f"_sd_{c}")
        flat = sd.isNull() | (sd == 0)
        return F.when(flat, F.lit(0.0)).otherwise(F.try_divide(F.col(c) - mean, sd))

    return attach_constant(table, moments).select(
        *table.columns, *(scored(c).alias(f"{c}{suffix}") for c in columns)
    )


def linear_fit(df: DataFrame, x: str, y: str) -> DataFrame:
    """SLOPE, INTERCEPT and the x range of the least-squares line; no row if undefined.

    Two distinct x values exist exactly when min and max differ, so no distinct count.
    """
    whole = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return whole.agg(
        F.regr_slope(y, x).alias("SLOPE"),
        F.regr_intercept(y, x).alias("INTERCEPT"),
        F.min(x).alias("X_MIN"),
        F.max(x).alias("X_MAX"),
    ).where("X_MIN < X_MAX")


def trend_line(df: DataFrame, x: str, y: str, points: int = 100) -> DataFrame:
    """``points`` evenly spaced X with fitted Y from the smallest to the largest x."""
    grid = linear_fit(df, x, y).withColumn(
        "POINT", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    )
    share = F.col("POINT") / F.lit(float(points - 1))
    at = F.col("X_MIN") + (F.col("X_MAX") - F.col("X_MIN")) * share
    return grid.select("POINT", at.alias("X"), (F.col("SLOPE") * at + F.col("INTERCEPT")).alias("Y"))


def histogram(
    df: DataFrame, value: str, by: Sequence[str] = (), low: float = 0, high: float = 100,
    bins: int = 20,
) -> DataFrame:
    """Row counts in ``bins`` equal bins; ``high`` itself belongs to the last bin.

    Values outside the range are counted too, as bin 0 and bin ``bins + 1``.
    """
    width = (high - low) / bins
    in_bin = F.width_bucket(F.col(value), F.lit(float(low)), F.lit(float(high)), F.lit(bins))
    number = F.when(F.col(value) == high, F.lit(bins)).otherwise(in_bin).cast("int")
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, number.alias("BIN")).count()
    return counts.select(
        *by,
        "BIN",
        (F.lit(float(low)) + (F.col("BIN") - 1) * width).alias("BIN_START"),
        (F.lit(float(low)) + F.col("BIN") * width).alias("BIN_END"),
        F.col("count").alias("ROWS"),
    )
