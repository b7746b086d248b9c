"""Metric tables kept up month by month.

Three metric tables and the turnover sums depend on the rows of one month only. They are stored in month folders; a
refresh compares the silver version they were built from with the current one and rewrites the months whose
silver folder is another, or is gone. Nothing else is read or written.

Layout under the path::

    <table>/write=<id>/MONTH=<month>/    rows, never changed
    _versions/<number>.json              months in force, the silver folder of each, the schemas

As in silver a version is one file, created once: readers see whole versions, and of two writers the second fails. The
folders of the last two versions stay.
"""

from __future__ import annotations

import datetime
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.contracts import RN_TURNOVER, TOTAL_TURNOVER
from panelforge.operators.panel import DEFAULT_LOOKBACK_MONTHS, lookback_start
from panelforge.plans.metrics import facility_panel, nurse_turnover, occupancy_trends, staffing_vs_occupancy
from panelforge.sources.files import create_once, delete, names_in, read_text
from panelforge.sources.silver import KEPT_VERSIONS, WRITE, ConcurrentCommit, SilverTable, Version

MONTH = "MONTH"
TURNOVER_SUMS = "turnover_sums"


def turnover_sums(recent: DataFrame) -> DataFrame:
    """Sum and count of both turnover figures per state and month: states of means that can be merged."""
    figures = (TOTAL_TURNOVER, RN_TURNOVER)
    return recent.groupBy("STATE", MONTH).agg(
        *(F.sum(c).alias(f"SUM_{c}") for c in figures), *(F.count(c).alias(f"COUNT_{c}") for c in figures)
    )


def merged_turnover(sums: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean turnover per ``keys`` (STATE, MONTH, both or none) over all rows behind the sums; NULL without any."""
    return sums.groupBy(*keys).agg(
        *(F.try_divide(F.sum(f"SUM_{c}"), F.sum(f"COUNT_{c}")).alias(c) for c in (TOTAL_TURNOVER, RN_TURNOVER))
    )


TABLES = {
    "01_occupancy_trends": occupancy_trends,
    "02_staffing_vs_occupancy": staffing_vs_occupancy,
    "05_nurse_turnover_trends": nurse_turnover,
    TURNOVER_SUMS: turnover_sums,
}


@dataclass(frozen=True)
class MonthlyVersion:
    """``silver`` maps a month to the silver write it was built from, ``months`` to the write that holds it here."""

    number: int
    silver: dict[str, str]
    months: dict[str, str]
    schemas: dict[str, dict]


class MonthlyMetrics:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        names = names_in(self.spark, f"{self.path}/_versions")
        return sorted(int(n[: -len(".json")]) for n in names if n.endswith(".json") and n[0] != ".")

    def _version_path(self, number: int) -> str:
        return f"{self.path}/_versions/{number:010d}.json"

    def version(self, number: int | None = None) -> MonthlyVersion | None:
        numbers = self._numbers()
        if number is None:
            number = numbers[-1] if numbers else None
        return None if number is None else MonthlyVersion(**json.loads(read_text(self.spark, self._version_path(number))))

    def read(self, name: str, months: int | None = DEFAULT_LOOKBACK_MONTHS) -> DataFrame:
        """A table's rows of the last ``months`` months (None: all); other folders are not opened."""
        version = self.version()
        if version is None:
            raise FileNotFoundError(f"no committed version in {self.path}")
        schema = T.StructType.fromJson(version.schemas[name])
        chosen = version.months
        if months is not None and chosen:
            latest = datetime.date.fromisoformat(max(chosen))
            first = lookback_start(latest, months).isoformat()
            chosen = {m: w for m, w in chosen.items() if m >= first}
        base = f"{self.path}/{name}"
        folders = [f"{base}/{WRITE}={w}/{MONTH}={m}" for m, w in sorted(chosen.items())]
        if not folders:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType(
            [f for f in schema.fields if f.name != MONTH]
            + [T.StructField(WRITE, T.StringType()), T.StructField(MONTH, T.DateType())]
        )
        return self.spark.read.schema(stored).option("basePath", base).parquet(*folders).select(*schema.names)

    def refresh(self, silver: SilverTable) -> list[str]:
        """Follow ``silver`` to its current version; returns the months rewritten.

        Silver months are first days of months, as file names give them; another date is an error. Rows without
        a month are in no table. With nothing changed no version is made. A month that left silver leaves here.
        """
        source, before = silver.version(), self.version()
        if source is None:
            raise FileNotFoundError(f"no committed version in {silver.path}")
        there = {m: w for m, w in source.months.items() if not m.startswith("__")}
        odd = sorted(m for m in there if not m.endswith("-01"))
        if odd:
            raise ValueError(f"snapshots that are no first day of a month: {', '.join(odd[:5])}")
        built = before.silver if before else {}
        touched = {m: w for m, w in there.items() if built.get(m) != w}
        if before and there == built:
            return []
        write = f"w{uuid.uuid4().hex}"
        months = {m: w for m, w in (before.months if before else {}).items() if m in there and m not in touched}
        schemas = dict(before.schemas) if before else {}
        try:
            if touched or not before:
                rows = silver.read(Version(source.number, source.schema, touched, None))
                recent = facility_panel(rows).withColumn(MONTH, F.col("SNAPSHOT_DATE"))
                for name, build in TABLES.items():
                    table = build(recent)
                    schemas[name] = json.loads(table.schema.json())
                    table.write.partitionBy(MONTH).parquet(f"{self.path}/{name}/{WRITE}={write}")
                months.update(dict.fromkeys(touched, write))
            version = MonthlyVersion(before.number + 1 if before else 0, there, months, schemas)
            if not create_once(self.spark, self._version_path(version.number), json.dumps(vars(version))):
                raise ConcurrentCommit(f"version {version.number} of {self.path} was committed by another writer")
        except BaseException:
            self._delete(write)
            raise
        self._retire()
        return sorted(touched)

    def _delete(self, write: str) -> None:
        for name in TABLES:
            delete(self.spark, f"{self.path}/{name}/{WRITE}={write}")

    def _retire(self) -> None:
        numbers = self._numbers()
        used = {w for n in numbers[-KEPT_VERSIONS:] for w in self.version(n).months.values()}
        for number in numbers[:-KEPT_VERSIONS]:
            for write in set(self.version(number).months.values()) - used:
                self._delete(write)
            delete(self.spark, self._version_path(number))
