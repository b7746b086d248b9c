"""What the operators share: reading tables, and scratch tables cut from the lineage."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(text: Column) -> Column:
    """32 bits of the text's hash, which with doc_id names a row even if ids repeat.

    Rows that agree in both are copies of one row and get the same result.
    """
    return F.xxhash64(text).bitwiseAND(F.lit(0xFFFFFFFF))


def text_bytes(docs: DataFrame) -> int:
    """UTF-8 bytes of all texts: one number, from a scan of the text column alone."""
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def even_parts(total: int, each: int) -> int:
    return max(1, math.ceil(total / each))
