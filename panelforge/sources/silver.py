"""The silver table: month folders, made current by a committed version.

Layout under the table's path::

    data/write=<id>/SNAPSHOT_DATE=<month>/    rows, written aside and never changed
    _ledger/<id>/                             one row per file: what was read of it
    _versions/<number>.json                   the months in force, their folders, the schema, the ledger

A version is one small file, created once. A reader opens the newest and sees exactly its months and columns, also
while a refresh runs: folders that are in force are not touched, and those of the last two versions stay. A writer
that comes second fails to create its version and leaves nothing behind.

The rows of a release are read in one pass. Records whose number of fields is not that of the header keep the place that a
permissive reader gives them; their raw text stays with the row, so that ``rejected`` can show them and the ledger
counts them per file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.dictionaries import PROCESSED_AT, SNAPSHOT_DATE, SOURCE_FILE
from panelforge.operators.typing import union_drifting
from panelforge.runtime import freeze
from panelforge.schemas import columns
from panelforge.sources.files import create_once, delete, names_in, path_exists, read_text

# A record that does not fit its header, as it stands in the file; null for all others.
RAW = "_RAW_RECORD"
WRITE = "write"
KEPT_VERSIONS = 2

LEDGER = T.StructType(
    [
        *columns(
            f"file_name string, path string, {SNAPSHOT_DATE} date, modificationTime timestamp, length long, "
            "readAt timestamp, rows long, malformed long, removed boolean"
        ).fields,
        T.StructField("header", T.ArrayType(T.StringType())),
    ]
)


class ConcurrentCommit(RuntimeError):
    """Another writer committed the version that this one was about to."""


@dataclass(frozen=True)
class Version:
    """One committed state: ``months`` maps a month to the write that holds its rows."""

    number: int
    schema: T.StructType
    months: dict[str, str]
    ledger: str | None

    def text(self) -> str:
        return json.dumps(
            {"number": self.number, "schema": json.loads(self.schema.json()), "months": self.months, "ledger": self.ledger}
        )

    @staticmethod
    def of(text: str) -> Version:
        kept = json.loads(text)
        return Version(kept["number"], T.StructType.fromJson(kept["schema"]), kept["months"], kept["ledger"])


class SilverTable:
    """Reads and commits versions of one table."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.data = f"{self.path}/data"

    # ---- reading

    def _numbers(self) -> list[int]:
        names = names_in(self.spark, f"{self.path}/_versions")
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0] != ".")

    def version(self, number: int | None = None) -> Version | None:
        """A committed version, the newest by default; None before the first."""
        numbers = self._numbers()
        if number is None:
            number = numbers[-1] if numbers else None
        return None if number is None else Version.of(read_text(self.spark, self._version_path(number)))

    def _version_path(self, number: int) -> str:
        return f"{self.path}/_versions/{number:010d}.json"

    def _rows(self, version: Version, with_raw: bool) -> DataFrame:
        fields = [f for f in version.schema.fields if f.name != SNAPSHOT_DATE]
        if with_raw:
            fields = [*fields, T.StructField(RAW, T.StringType())]
        kept = [T.StructField(SNAPSHOT_DATE, T.DateType())] if SNAPSHOT_DATE in version.schema.names else []
        schema = T.StructType([*fields, T.StructField(WRITE, T.StringType()), *kept])
        names = [n for n in version.schema.names] + ([RAW] if with_raw else [])
        folders = [f"{self.data}/{WRITE}={w}/{SNAPSHOT_DATE}={m}" for m, w in sorted(version.months.items())]
        if not folders:
            return self.spark.createDataFrame([], schema).select(*names)
        return self.spark.read.schema(schema).option("basePath", self.data).parquet(*folders).select(*names)

    def read(self, version: Version | None = None) -> DataFrame:
        """All rows of a version, under the schema stored with it. A filter on the month prunes folders."""
        return self._rows(self._existing(version), with_raw=False)

    def rejected(self, version: Version | None = None) -> DataFrame:
        """File, month and raw text of every record whose fields do not match its header."""
        rows = self._rows(self._existing(version), with_raw=True)
        return rows.where(F.col(RAW).isNotNull()).select(SOURCE_FILE, SNAPSHOT_DATE, F.col(RAW).alias("RECORD"))

    def _existing(self, version: Version | None) -> Version:
        version = version or self.version()
        if version is None:
            raise FileNotFoundError(f"no committed version in {self.path}")
        return version

    def ledger(self, version: Version | None = None) -> DataFrame:
        """What is known of each file, removed ones included; empty before the first commit."""
        version = version or self.version()
        if version is None or version.ledger is None:
            return self.spark.createDataFrame([], LEDGER)
        return self.spark.read.schema(LEDGER).parquet(f"{self.path}/_ledger/{version.ledger}")

    # ---- writing

    def commit(
        self,
        before: Version | None,
        rows: DataFrame | None,
        schema: T.StructType,
        dropped_months: Sequence[str],
        ledger: DataFrame | None,
    ) -> Version:
        """Put ``rows`` in place of the months they lie in and of ``dropped_months``.

        ``ledger`` is given as it will be, but for the counts of files in ``rows``, which are taken from what was
        written. Without it, it is made from the rows.
        """
        write = uuid.uuid4().hex
        months = {m: w for m, w in (before.months if before else {}).items() if m not in set(dropped_months)}
        try:
            if rows is not None:
                rows.write.partitionBy(SNAPSHOT_DATE).parquet(f"{self.data}/{WRITE}=w{write}")
                for name in names_in(self.spark, f"{self.data}/{WRITE}=w{write}"):
                    if name.startswith(f"{SNAPSHOT_DATE}="):
                        months[unquote(name.split("=", 1)[1])] = f"w{write}"
            version = Version(before.number + 1 if before else 0, schema, months, write)
            self._counted(version, ledger, f"w{write}").select(*LEDGER.names).write.parquet(f"{self.path}/_ledger/{write}")
            if not create_once(self.spark, self._version_path(version.number), version.text()):
                raise ConcurrentCommit(f"version {version.number} of {self.path} was committed by another writer")
        except BaseException:
            delete(self.spark, f"{self.data}/{WRITE}=w{write}")
            delete(self.spark, f"{self.path}/_ledger/{write}")
            raise
        self._retire()
        return version

    def _counted(self, version: Version, ledger: DataFrame | None, write: str) -> DataFrame:
        """The ledger with the row counts of the months just written."""
        new = Version(version.number, version.schema, {m: w for m, w in version.months.items() if w == write}, None)
        counts = (
            self._rows(new, with_raw=True)
            .groupBy(F.col(SOURCE_FILE).alias("file_name"), F.col(SNAPSHOT_DATE).alias("_month"))
            .agg(F.count(F.lit(1)).alias("_rows"), F.count(RAW).alias("_malformed"))
        )
        if ledger is None:
            return counts.select(
                "file_name", F.lit(None).cast("string").alias("path"), F.col("_month").alias(SNAPSHOT_DATE),
                F.lit(None).cast("timestamp").alias("modificationTime"), F.lit(None).cast("long").alias("length"),
                F.current_timestamp().alias("readAt"), F.col("_rows").alias("rows"), F.col("_malformed").alias("malformed"),
                F.lit(False).alias("removed"), F.lit(None).cast("array<string>").alias("header"),
            )
        zero = F.lit(0).cast("long")
        return ledger.join(counts, "file_name", "left").withColumns(
            {
                "rows": F.coalesce("_rows", "rows", zero),
                "malformed": F.coalesce("_malformed", "malformed", zero),
            }
        )

    def _retire(self) -> None:
        """Drop all but the newest versions, and the folders that only dropped ones name."""
        numbers = self._numbers()
        old, kept = numbers[:-KEPT_VERSIONS], [self.version(n) for n in numbers[-KEPT_VERSIONS:]]
        if not old:
            return
        used = {w for v in kept for w in v.months.values()}
        ledgers = {v.ledger for v in kept}
        for version in [self.version(n) for n in old]:
            for write in set(version.months.values()) - used:
                delete(self.spark, f"{self.data}/{WRITE}={write}")
            if version.ledger not in ledgers:
                delete(self.spark, f"{self.path}/_ledger/{version.ledger}")
            delete(self.spark, self._version_path(version.number))

    def replace_all(self, df: DataFrame) -> Version:
        """``df`` as the whole table."""
        before = self.version()
        schema = T.StructType([f for f in df.schema.fields if f.name != RAW])
        rows = df if RAW in df.columns else df.withColumn(RAW, F.lit(None).cast("string"))
        return self.commit(before, rows, schema, list(before.months) if before else [], None)

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_versions")

    def apply(
        self, ledger: DataFrame, fresh: DataFrame | None, pending: DataFrame, months: Sequence[str], schema: T.StructType
    ) -> Version:
        """Commit one step of a refresh.

        ``pending`` names the files (file_name) of ``months`` whose rows give way, ``fresh`` holds the rows of those
        that were read, and ``ledger`` is the ledger afterwards. All other months keep their folders; in these,
        rows of other files are carried over.
        """
        before = self.version()
        rows = [fresh] if fresh is not None else []
        old = [m for m in months if before and m in before.months]
        if old:
            there = Version(before.number, before.schema, {m: before.months[m] for m in old}, None)
            gone = F.broadcast(pending.select(F.col("file_name").alias(SOURCE_FILE)))
            rows.append(self._rows(there, with_raw=True).join(gone, SOURCE_FILE, "left_anti"))
        return self.commit(before, union_drifting(rows) if rows else None, schema, months, ledger)


def reconciled(listed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every file of the listing or the ledger with what has to be done about it.

    ``state`` is new, changed (another time or length than when it was read, or a file that comes back), removed,
    gone (removed before) or same. A renamed file is a removed and a new one. One full outer join by name.
    """
    known = ledger.select(*(F.col(c).alias(f"_{c}") for c in LEDGER.names))
    both = listed.select("file_name", "path", SNAPSHOT_DATE, "modificationTime", "length").join(
        known, F.col("file_name") == F.col("_file_name"), "full_outer"
    )
    same = F.col("modificationTime").eqNullSafe(F.col("_modificationTime")) & F.col("length").eqNullSafe(F.col("_length"))
    state = (
        F.when(F.col("file_name").isNull(), F.when(F.col("_removed"), "gone").otherwise("removed"))
        .when(F.col("_file_name").isNull(), "new")
        .when(F.col("_removed") | ~same, "changed")
        .otherwise("same")
    )
    here = F.col("file_name").isNotNull()
    return both.select(
        F.coalesce("file_name", "_file_name").alias("file_name"),
        F.coalesce("path", "_path").alias("path"),
        F.coalesce(SNAPSHOT_DATE, f"_{SNAPSHOT_DATE}").alias(SNAPSHOT_DATE),
        F.when(here, F.col("modificationTime")).otherwise(F.col("_modificationTime")).alias("modificationTime"),
        F.when(here, F.col("length")).otherwise(F.col("_length")).alias("length"),
        F.col("_readAt").alias("readAt"),
        F.col("_rows").alias("rows"),
        F.col("_malformed").alias("malformed"),
        F.coalesce("_removed", F.lit(False)).alias("removed"),
        F.col("_header").alias("header"),
        state.alias("state"),
    )


def frozen_plan(listed: DataFrame, table: SilverTable) -> DataFrame:
    """``reconciled`` as a written table: the listing is taken once a refresh."""
    return freeze(reconciled(listed, table.ledger()))


def metadata_fields() -> list[T.StructField]:
    return [
        T.StructField(SOURCE_FILE, T.StringType()),
        T.StructField(PROCESSED_AT, T.TimestampType()),
        T.StructField(SNAPSHOT_DATE, T.DateType()),
    ]
