"""Shards that all carry the mixture of the whole table.

Proportional stratified interleaving. The rows of each source are put in a seeded random
order and get the fractional rank (rank - 1/2) / rows of the source. Sorted by that fraction, every
stretch of the table holds each source in proportion, so equal cuts of the order are shards
with equal row counts and the same mixture.

Scale. Only ids, sizes and checksums move. Both orders are full rankings by range exchange
(``rank_rows``): a source with a third of all rows spreads over many slices.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.operators.joins import attach
from panelforge.operators.rank import rank_rows
from panelforge.runtime import freeze

ROW_BYTES = 16


def interleave(docs: DataFrame, shards: int = 40, seed: int = 0) -> DataFrame:
    """Put every row of ``docs`` (doc_id, text, source) into one of ``shards`` shards.

    Returns doc_id, size (UTF-8 bytes of the text plus 16), text_crc32, law (``rows``: counts of
    shards differ by at most one), shard, slot (gapless from 0 in each shard), grown_shard
    (null: this law moves rows when shards are added).

    Null text has size 16 and the checksum of no bytes. Null sources are a source of their own.
    Repeated rows are placed one by one; copies of a text may lie in different shards, as a
    group larger than a shard has to. With fewer rows than shards some stay empty. The order
    within a source depends on seed, doc_id, text and, for rows equal in these, nothing.
    """
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.col("source").cast("string").alias("source"),
    ).withColumn(
        "draw", F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text_crc32"), F.col("source"))
    )
    ranked = freeze(
        rank_rows(rows, [F.col("draw")], ["draw"], "_rank", ["source"], "_in_source")
    )
    sizes = ranked.groupBy("source").agg(F.count(F.lit(1)).alias("_rows"))
    spread = attach(ranked, sizes, ["source"], match_nulls=True).select(
        "doc_id", "size", "text_crc32", "source", "draw",
        ((F.col("_in_source") - 0.5) / F.col("_rows")).alias("_share"),
    )
    total = ranked.count()
    placed = rank_rows(
        spread, [F.col("_share"), F.col("draw")], ["_share", "draw"], "_place"
    ).withColumn("_p", F.col("_place") - 1)
    shard = F.expr(f"_p * {shards} DIV {max(total, 1)}")
    # The first place of shard s is s * rows / shards, rounded up.
    begin = F.expr(f"(_shard * {total} + {shards - 1}) DIV {shards}")
    return placed.withColumn("_shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_p") - begin).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "source",
    )
