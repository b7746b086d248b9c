"""Full ranking of a table without moving it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelforge.operators.topk import tie_columns
from panelforge.runtime import freeze

# monotonically_increasing_id() keeps the row position in its low 33 bits.
_POSITION_BITS = 33


def rank_rows(
    df: DataFrame,
    order: Sequence[Column],
    order_columns: Sequence[str],
    rank_column: str,
    group: Sequence[str] = (),
    group_rank_column: str | None = None,
    slices: int | None = None,
) -> DataFrame:
    """``row_number`` over the whole table and, optionally, within each ``group``.

    Equal to ``row_number().over(Window.orderBy(order, remaining columns))`` and the same
    window partitioned by ``group``, as longs; NULL group values form a group of their own.

    1. One range exchange cuts the table into ordered slices. Its key is the full order, all
       remaining columns and the partition a row came from, so one value held by a third of
       the table, or copies of one row, still spread over slices; and a task that runs again
       sends every row to the same slice.
    2. The sorted slices are written once with slice number and position, which fixes the
       cut for the later steps even if an executor is lost.
    3. Global rank = position + size of the earlier slices (one row per slice, broadcast).
    4. Group rank = position among the group's rows in the slice + the group's size in the
       earlier slices. The largest unit of work is a slice, never a group.
    """
    spark = df.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = [*order, *tie_columns(df, order_columns)]
    ranged = (
        df.withColumn("_from", F.spark_partition_id())
        .repartitionByRange(slices, *total, F.col("_from"))
        .sortWithinPartitions(*total)
        .drop("_from")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    columns = [F.col(f"`{c}`") for c in df.columns]
    cut = freeze(
        ranged.select(
            *columns,
            F.shiftright("_at", _POSITION_BITS).alias("_slice"),
            F.col("_at").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("_pos"),
        )
    )

    # At most ``slices`` rows, whatever the table size.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        cut.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_slice", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    ranked = cut.join(F.broadcast(starts), "_slice").withColumn(
        rank_column, F.col("_pos") + F.col("_before") + 1
    )
    wanted = [*columns, F.col(rank_column)]

    if group_rank_column:
        # A struct key is never NULL and compares by value, so NULL groups match.
        key = F.struct(*(F.col(f"`{g}`") for g in group)).alias("_g")
        in_slice = Window.partitionBy("_slice", "_g").orderBy("_pos")
        sooner = (
            Window.partitionBy("_g")
            .orderBy("_slice")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        group_starts = (
            cut.select("_slice", key)
            .groupBy("_slice", "_g")
            .agg(F.count(F.lit(1)).alias("_n"))
            .select(
                "_slice", "_g", F.coalesce(F.sum("_n").over(sooner), F.lit(0)).alias("_gbefore")
            )
        )
        ranked = (
            ranked.withColumn("_g", key)
            .withColumn("_rn", F.row_number().over(in_slice))
            .join(group_starts, ["_slice", "_g"])
            .withColumn(group_rank_column, F.col("_rn") + F.col("_gbefore"))
        )
        wanted.append(F.col(group_rank_column))
    return ranked.select(*wanted)
