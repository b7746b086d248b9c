"""Each row together with the next row of a table too large to sort in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.llm.tables import partitions, row_key
from panelforge.runtime import freeze

_NONE = -(1 << 63)


def in_slices(docs: DataFrame, slices: int | None = None) -> DataFrame:
    """Cut ``docs`` (doc_id, text) into slices of descending doc_id, each followed by the next row.

    Columns _slice, doc_id, text, _guest. Rows of one slice lie in one partition in descending
    order of doc_id (null last; equal ids by the hash of the text); the row with _guest true
    ends the slice: a copy of the first row of the next one, or after the last slice of the first.

    The cuts are quantiles of doc_id: one number a slice reaches the driver, and one text a
    slice is sent twice. A doc_id (or the rows without one) that holds several quantiles is cut further by the
    hash of the text, so slices are equal in number unless rows agree in both.
    """
    spark = docs.sparkSession
    slices = slices or 4 * partitions(spark)
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NONE)).alias("_order"),
        row_key(F.col("text")).alias("_key"),
        "text",
    )
    shares = [i / slices for i in range(1, slices)] or [0.5]
    cuts = rows.agg(F.percentile_approx("_order", shares, 10 * slices)).first()[0]
    edges, parts = np.unique(np.array(cuts or [], np.int64), return_counts=True)
    # Slices before those that begin at edge r - 1; the last one lies below all edges.
    before = np.append(np.cumsum(parts[::-1])[::-1], 0)

    @F.pandas_udf("int")
    def slice_of(order: pd.Series, key: pd.Series) -> pd.Series:
        order, key = order.to_numpy(), key.to_numpy()
        r = np.searchsorted(edges, order, "right")
        at = np.maximum(r - 1, 0)
        hot = (r > 0) & (edges[at] == order) if len(edges) else np.zeros(len(order), bool)
        # Keys have 32 bits.
        part = key * parts[at] >> 32 if len(edges) else 0
        return pd.Series(before[r] + np.where(hot, part, 0))

    rows = rows.withColumn("_slice", slice_of("_order", "_key"))
    # First row of each slice: the largest doc_id, then the smallest key.
    heads = (
        rows.groupBy("_slice")
        .agg(F.max(F.struct("_order", -F.col("_key"))).alias("h"))
        .select("_slice", "h._order", (-F.col("h.col2")).alias("_key"))
        .collect()
    )
    heads.sort(key=lambda r: r[0])
    if not heads:
        return rows.select(
            "_slice", F.col("_order").alias("doc_id"), "text", F.lit(False).alias("_guest")
        )
    # At most one row a slice: the head of each slice is a guest of the slice before.
    hosts = spark.createDataFrame(
        [(heads[i - 1][0], h[1], h[2]) for i, h in enumerate(heads)],
        "_host int, _order long, _key long",
    )
    guests = freeze(
        rows.drop("_slice")
        .join(F.broadcast(hosts), ["_order", "_key"])
        .dropDuplicates(["_host"])
        .select(F.col("_host").alias("_slice"), "_order", "_key", "text", F.lit(True).alias("_guest"))
    )
    return (
        rows.select("_slice", "_order", "_key", "text", F.lit(False).alias("_guest"))
        .unionByName(guests)
        .repartition(partitions(spark), "_slice")
        .sortWithinPartitions("_slice", "_guest", F.desc("_order"), "_key")
        .select(
            "_slice",
            F.when(F.col("_order") != _NONE, F.col("_order")).alias("doc_id"),
            "text",
            "_guest",
        )
    )


def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """From the batches of ``in_slices``: doc_ids and texts, where each row but the last of the
    lists is followed by its next row. Guests, which only follow, have doc_id ``Ellipsis``."""
    ids, texts = [], []
    for batch in batches:
        ids += [
            ... if guest else doc_id
            for doc_id, guest in zip(batch.column("doc_id").to_pylist(), batch.column("_guest").to_pylist())
        ]
        texts += [t or "" for t in batch.column("text").to_pylist()]
        if len(ids) > 1:
            yield ids, texts
            ids, texts = ids[-1:], texts[-1:]
