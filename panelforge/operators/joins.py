"""Joining group values back onto detail rows without funnelling a hot group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.runtime import freeze, freeze_measured

# A side up to this many bytes may be sent to every executor.
BROADCAST_BYTES = 64 << 20


def _key(keys: Sequence[str]) -> Column:
    """The key as one value; a struct is never NULL and compares by its fields."""
    return F.struct(*(F.col(f"`{k}`") for k in keys))


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys holding more rows than an even share of one shuffle partition, as ``_hot``.

    There are always fewer of them than shuffle partitions, so they can be broadcast.
    """
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = freeze(df.groupBy(_key(keys).alias("_hot")).agg(F.count(F.lit(1)).alias("_n")))
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    return sizes.where(F.col("_n") * slices > total).select("_hot")


def attach(
    detail: DataFrame,
    side: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    match_nulls: bool = False,
    side_bytes: int | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join ``side`` (one row per key) onto ``detail``.

    ``side`` is written once and measured exactly. If it fits ``broadcast_bytes`` the
    detail is not shuffled at all. Otherwise the rows of the hot keys, which number fewer
    than the shuffle partitions, meet a broadcast of just those keys where they are read,
    and only the rest, in which no key exceeds an even share, is shuffled. Both ways give
    the same rows. Pass ``side_bytes`` for a side that was already measured.
    """
    if side_bytes is None:
        side, _, side_bytes = freeze_measured(side)
    values = [c for c in side.columns if c not in keys]
    kept = [F.col(f"`{c}`") for c in [*detail.columns, *values]]

    def joined(rows: DataFrame, values_of: DataFrame, small: bool) -> DataFrame:
        renamed = values_of.select(
            *(F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)),
            *(F.col(f"`{v}`") for v in values),
        )
        test = F.lit(True)
        for i, k in enumerate(keys):
            left, right = F.col(f"`{k}`"), F.col(f"_k{i}")
            test = test & (left.eqNullSafe(right) if match_nulls else left == right)
        return rows.join(F.broadcast(renamed) if small else renamed, test, how).select(*kept)

    if side_bytes <= broadcast_bytes:
        return joined(detail, side, small=True)

    hot = F.broadcast(hot_keys(detail, keys))
    is_hot = _key(keys) == F.col("_hot")
    return joined(
        detail.join(hot, is_hot, "left_semi"), side.join(hot, is_hot, "left_semi"), small=True
    ).unionByName(joined(detail.join(hot, is_hot, "left_anti"), side, small=False))


def attach_constant(detail: DataFrame, one_row: DataFrame) -> DataFrame:
    """Repeat the single row of a keyless aggregate on every detail row."""
    return detail.crossJoin(F.broadcast(one_row))
