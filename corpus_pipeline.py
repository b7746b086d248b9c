"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), calls one operator on all rows its predecessor kept, and
returns what it keeps; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelforge.llm.decontamination import without_items
from panelforge.llm.language import in_known_language
from panelforge.llm.lines import remove_repeated_blocks
from panelforge.llm.neardup import one_per_group
from panelforge.llm.packing import pack
from panelforge.llm.tables import table
from panelforge.runtime import freeze


# Rows handed to a Python task at once. Texts are long, and both sides of the hand-over keep a batch in memory.
BATCH_ROWS = 500


def _small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size; a smaller one set by the user stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    rows = int(spark.conf.get(name, "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in none of the learned languages, go."""
    _small_batches(spark)
    return in_known_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated blocks of lines go; so do documents of which nothing but blanks is left.

    ``n_chars`` follows the text where the text changed.
    """
    _small_batches(spark)
    changed = remove_repeated_blocks(docs)
    row, removed = F.col("row"), F.col("n_removed") > 0
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        chars = F.when(removed, F.char_length("row.text").cast(kind)).otherwise(F.col("row.n_chars"))
        row = row.withField("n_chars", chars)
    empty = removed & F.col("row.text").rlike(r"^\s*$")
    return changed.where(~empty).select(row.alias("row")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    _small_batches(spark)
    return one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    _small_batches(spark)
    return without_items(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens: one row per piece of a document."""
    _small_batches(spark)
    return pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

# The network, the hashes and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)


PIPELINE_QUERIES = {"pipeline": run}
PIPELINE_ORACLES: dict[str, str] = {}
