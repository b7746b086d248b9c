"""Nearest-date join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.measures import day_distance
from panelforge.operators.joins import BROADCAST_BYTES
from panelforge.operators.topk import first_per_key
from panelforge.runtime import freeze_measured


def nearest_join(
    panel: DataFrame,
    anchors: DataFrame,
    keys: Sequence[str],
    panel_date: str,
    anchor_date: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """For each key, the panel row nearest in days (before or after) to the anchor.

    Ties go to the later panel date, a NULL distance comes last, and further ties go to
    the smallest remaining values. ``anchors`` holds one row per key.

    The anchors are written once and measured. If they fit ``broadcast_bytes``, the panel
    meets them where it is read and every task ships one row per key at most. Otherwise
    the panel is first reduced to one row per key and date, which bounds a key to one row
    per calendar day before the join. That loses nothing: rows of one key and date are
    all equally near, and the tie rule picks the same one either way.
    """
    anchors, _, size = freeze_measured(anchors)
    if size <= broadcast_bytes:
        anchors = F.broadcast(anchors)
    else:
        panel = first_per_key(panel, [*keys, panel_date], [])
    pairs = panel.join(anchors, list(keys), "inner").withColumn(
        "_days", day_distance(F.col(panel_date), F.col(anchor_date))
    )
    order = [F.col("_days").asc_nulls_last(), F.col(panel_date).desc_nulls_last()]
    return first_per_key(pairs, keys, order).drop("_days")
