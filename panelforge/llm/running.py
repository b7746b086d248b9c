"""Running sums along a key without gathering the key in one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.llm.tables import partitions
from panelforge.runtime import freeze

# monotonically_increasing_id() keeps the row position in its low 33 bits.
_POSITION_BITS = 33


def in_order(df: DataFrame, key: str, order: Sequence[Column], keep: Mapping[str, Column]) -> DataFrame:
    """``key`` and the columns ``keep`` of ``df``, written in the order of key and ``order``.

    ``_slice`` and ``_at`` say where a row lies: a key is one row range, cut anywhere, so that a key with
    a third of all rows spreads over a third of the slices. The partition a row comes from ends the
    range key, for the same reason: rows that are equal in all of it are spread as well.
    """
    total = [F.col(key), *order]
    ranged = (
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(partitions(df.sparkSession), *total, F.col("_from"))
        .sortWithinPartitions(*total)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    columns = {n: c for n, c in keep.items() if n != key}
    return freeze(
        ranged.select(key, *(c.alias(n) for n, c in columns.items()), F.shiftright("_at", _POSITION_BITS).alias("_slice"), "_at")
    )


def running(cut: DataFrame, key: str, sums: Mapping[str, Column]) -> DataFrame:
    """``cut`` with the running sums (longs, the row itself included) of ``sums`` along each key.

    Each slice sums up its own rows. Only the first and the last key of a slice can go on in others: the
    sums of these, two rows a slice at most, are added up over the slices and attached.
    """
    ends = cut.groupBy("_slice").agg(F.min(key).alias("_low"), F.max(key).alias("_high"))
    edge = cut.join(F.broadcast(ends), "_slice").where((F.col(key) == F.col("_low")) | (F.col(key) == F.col("_high")))
    totals = edge.groupBy("_slice", key).agg(*(F.sum(c).alias(n) for n, c in sums.items()))
    earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select(
        F.col("_slice").alias("_s"), F.col(key).alias("_k"), *(F.sum(n).over(earlier).alias(f"_{n}") for n in sums)
    ).where(F.col(f"_{next(iter(sums))}").isNotNull())
    inside = Window.partitionBy("_slice", key).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.select("*", *(F.sum(c).over(inside).alias(f"_in_{n}") for n, c in sums.items()))
    summed = summed.join(F.broadcast(before), (F.col("_slice") == F.col("_s")) & (F.col(key) == F.col("_k")), "left")
    return summed.select(
        *cut.columns, *((F.col(f"_in_{n}") + F.coalesce(F.col(f"_{n}"), F.lit(0))).alias(n) for n in sums)
    )
