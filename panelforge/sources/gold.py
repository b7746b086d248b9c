"""Metric tables as Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.operators.contracts import (
    DASHBOARD_SCHEMAS,
    DASHBOARD_TABLES,
    GOLD_ORDER,
    conform,
)


def in_order(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Globally sorted rows, for locality in the files.

    The sort key ends in the partition a row came from: rows equal in every listed column
    would otherwise all land in one task.
    """
    return (
        df.withColumn("_from", F.spark_partition_id())
        .orderBy(*(F.col(c) for c in columns), "_from")
        .drop("_from")
    )


def write_gold(df: DataFrame, base: str, table: str) -> str:
    """Overwrite one metric table, in its declared order."""
    path = f"{base.rstrip('/')}/{table}"
    in_order(df, GOLD_ORDER[table]).write.mode("overwrite").parquet(path)
    return path


def read_gold(spark: SparkSession, base: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{base.rstrip('/')}/{table}")


def load_dashboard(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """The tables the dashboard asks for, lazily, checked and coerced to their contract."""
    return {
        name: conform(read_gold(spark, base, table), DASHBOARD_SCHEMAS[name], name)
        for name, table in DASHBOARD_TABLES.items()
    }
