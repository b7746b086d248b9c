"""Monthly CSV snapshots: discovery, drift-safe reading, the silver build."""

from __future__ import annotations

import csv
import datetime
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.dictionaries import (
    PROCESSED_AT,
    RESERVED,
    SNAPSHOT_DATE,
    SOURCE_FILE,
    SnapshotFamily,
)
from panelforge.functions.names import snapshot_month
from panelforge.operators.contracts import normalized_names, reject_reserved, require_columns
from panelforge.operators.typing import apply_dictionary, union_drifting
from panelforge.sources.files import first_lines
from panelforge.sources.silver import RAW, SilverTable, metadata_fields

# How the snapshot files are written.
CSV_OPTIONS = {
    "header": "true",
    "inferSchema": "false",
    "mode": "PERMISSIVE",
    "quote": '"',
    "escape": '"',
}


def csv_glob(folder: str) -> str:
    """The CSV files directly in ``folder``. Subfolders are neither listed nor read as
    partitions."""
    return f"{folder.rstrip('/')}/*.[cC][sS][vV]"


def matching(files: DataFrame, family: SnapshotFamily) -> DataFrame:
    """Name and path of the listed files that belong to ``family``."""
    named = files.select(
        "path", F.substring_index("path", "/", -1).alias("file_name"), "length", "modificationTime"
    )
    return named.where(F.col("file_name").rlike(family.file_pattern))


def list_snapshots(spark: SparkSession, folder: str, family: SnapshotFamily) -> DataFrame:
    """Matching files directly in ``folder`` with their month. File contents are not read."""
    try:
        files = spark.read.format("binaryFile").load(csv_glob(folder))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no CSV file in {folder}") from error
    return with_month(matching(files, family))


def with_month(files: DataFrame) -> DataFrame:
    return files.withColumn(SNAPSHOT_DATE, snapshot_month(F.col("file_name")))


@dataclass(frozen=True)
class SnapshotFile:
    path: str
    name: str
    month: datetime.date


def known_files(rows: Sequence) -> list[SnapshotFile]:
    """Files in path order. A name without a month is an error."""
    for row in rows:
        if row[SNAPSHOT_DATE] is None:
            raise ValueError(f"no month can be read from the file name {row['file_name']!r}")
    return [SnapshotFile(r["path"], r["file_name"], r[SNAPSHOT_DATE]) for r in sorted(rows, key=lambda r: r["path"])]


def resolve(files: DataFrame, family: SnapshotFamily, where: str) -> list[SnapshotFile]:
    """The file list itself, in path order. No file, or a name without a month, is an error."""
    rows = files.select("path", "file_name", SNAPSHOT_DATE).collect()
    if not rows:
        raise FileNotFoundError(f"no {family.label} matching {family.file_pattern} in {where}")
    return known_files(rows)


def discover(spark: SparkSession, folder: str, family: SnapshotFamily) -> list[SnapshotFile]:
    return resolve(list_snapshots(spark, folder, family), family, folder)


def headers(spark: SparkSession, paths: Sequence[str]) -> list[tuple[str, ...]]:
    """Header of each file, from its first bytes; see ``first_lines``.

    Names are made unique as Spark's CSV reader does it.
    """
    return [_header_names(line.text) for line in first_lines(spark, paths)]


def _header_names(line: str) -> tuple[str, ...]:
    names = next(csv.reader([line.lstrip("\ufeff")]), []) if line else []
    seen = Counter(n.lower() for n in names)
    return tuple(
        f"_c{i}" if not n else f"{n}{i}" if seen[n.lower()] > 1 else n for i, n in enumerate(names)
    )


def read_snapshots(
    spark: SparkSession,
    files: Sequence[SnapshotFile],
    family: SnapshotFamily,
    known: Sequence[tuple[str, ...]] | None = None,
    with_raw: bool = False,
) -> DataFrame:
    """All snapshots as text under normalised names, with file name and month.

    Spark applies one header by position when it reads several CSV files, so files are
    grouped by identical header and every group is one scan; years of unchanged releases
    cost one scan, not one per month. ``known`` gives headers that were read before. ``with_raw`` adds the
    raw text of records that have more or fewer fields than their header; they are read all the same.
    """
    groups: dict[tuple[str, ...], list[SnapshotFile]] = {}
    for file, header in zip(files, known or headers(spark, [f.path for f in files]), strict=True):
        groups.setdefault(header, []).append(file)

    misfit = spark.conf.get("spark.sql.columnNameOfCorruptRecord", "_corrupt_record")
    frames = []
    for header, members in groups.items():
        source = members[0].name
        names = normalized_names(list(header), source)
        reject_reserved(names, source)
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *[misfit] * with_raw]])
        scan = spark.read.options(**CSV_OPTIONS).schema(schema).csv([f.path for f in members])
        require_columns(scan, family.required, source)
        name = F.col("_metadata.file_name")
        raw = [F.col(f"`{misfit}`").alias(RAW)] * with_raw
        frames.append(
            scan.select(*(f"`{n}`" for n in names), *raw, name.alias(SOURCE_FILE), snapshot_month(name).alias(SNAPSHOT_DATE))
        )
    return union_drifting(frames)


def silver(
    spark: SparkSession,
    files: Sequence[SnapshotFile],
    family: SnapshotFamily,
    known: Sequence[tuple[str, ...]] | None = None,
    with_raw: bool = False,
) -> DataFrame:
    read = read_snapshots(spark, files, family, known, with_raw).withColumn(PROCESSED_AT, F.current_timestamp())
    return require_columns(apply_dictionary(read, family, (*RESERVED, RAW)), family.required, family.label)


# Types of cleaned columns; all others stay text.
_TYPES = {"date": T.DateType(), "number": T.DoubleType()}


def silver_schema(found: Sequence[Sequence[str]], family: SnapshotFamily) -> T.StructType:
    """Columns of silver for files with these headers: those of the build, the added ones last."""
    names = dict.fromkeys(n for header in found for n in normalized_names(list(header), family.label))
    fields = [T.StructField(n, _TYPES.get(family.kinds.get(n), T.StringType())) for n in names]
    return T.StructType([*fields, *metadata_fields()])


def build_silver(spark: SparkSession, folder: str, family: SnapshotFamily) -> DataFrame:
    """Every snapshot in ``folder``, typed, with the three metadata columns."""
    return silver(spark, discover(spark, folder, family), family)


def write_silver(df: DataFrame, path: str) -> dict:
    """``df`` as the whole silver table at ``path``, committed as its next version.

    Returns number, rows, columns and schema of the version, from the one pass that writes it.
    """
    watch = Observation()
    observed = df.observe(watch, F.count(F.lit(1)).alias("rows"))
    version = SilverTable(df.sparkSession, path).replace_all(observed)
    return {
        "version": version.number,
        "rows": watch.get["rows"],
        "columns": len([c for c in df.columns if c != RAW]),
        "schema": df.schema,
    }


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """The committed rows of a silver table, under the schema stored with them."""
    return SilverTable(spark, path).read()


def rejected_rows(spark: SparkSession, path: str) -> DataFrame:
    """Records of the silver table that do not fit their header: file, month and raw text."""
    return SilverTable(spark, path).rejected()
