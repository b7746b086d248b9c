"""Incremental silver: new snapshot files, each processed once."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from panelforge.functions.dictionaries import SNAPSHOT_DATE, SnapshotFamily
from panelforge.operators.rank import rank_rows
from panelforge.runtime import freeze
from panelforge.schemas import columns
from panelforge.sources.silver import LEDGER, SilverTable, frozen_plan
from panelforge.sources.snapshots import (
    csv_glob,
    headers,
    known_files,
    list_snapshots,
    matching,
    silver,
    silver_schema,
    with_month,
)

# Columns of Spark's binaryFile source. Only names are selected; contents are pruned.
FILES = columns(
    "path string, modificationTime timestamp, length long, content binary"
)

# Spark forgets files this much older than the newest one; back-filled months are years old.
ANY_AGE = "36500d"


def snapshot_stream(
    spark: SparkSession,
    folder: str,
    family: SnapshotFamily,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Read every snapshot file not seen before and stop.

    Files count however old they are, but the stream knows them by name only: releases that
    are written again under their name are for ``refresh_silver``.

    The stream carries file names. Each micro-batch reads its files grouped by header, so
    a changed layout is a wider union and not a broken stream schema, and commits a version in which
    they replace their own rows: replaying a batch after a failure changes nothing.
    The file list of one batch, at most ``files_per_batch`` names, is known to the driver.
    """
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("maxFileAge", ANY_AGE)
        .load(csv_glob(folder))
    )

    def land(batch: DataFrame, _batch_id: int) -> None:
        session = batch.sparkSession
        if not batch.isEmpty():
            _land(SilverTable(session, target), with_month(batch).withColumn("state", F.lit("new")), family)

    return (
        matching(files, family)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _land(table: SilverTable, batch: DataFrame, family: SnapshotFamily) -> int:
    """Read the files of ``batch`` (as ``reconciled``) anew, drop the rows of removed ones, and commit.

    The names of one batch, bounded by its caller, are known to the driver; all else stays in tables.
    """
    spark = table.spark
    named = batch.select("file_name", "path", SNAPSHOT_DATE, "modificationTime", "length", "state").collect()
    found = known_files([r for r in named if r["state"] != "removed"])
    lines = headers(spark, [f.path for f in found])
    rows = silver(spark, found, family, lines, with_raw=True) if found else None
    header = {f.name: list(h) for f, h in zip(found, lines)}
    now = datetime.datetime.now(datetime.timezone.utc)
    updates = spark.createDataFrame(
        [
            (r["file_name"], r["path"], r[SNAPSHOT_DATE], r["modificationTime"], r["length"], now, None, None,
             r["state"] == "removed", header.get(r["file_name"]))
            for r in named
        ],
        LEDGER,
    )
    others = table.ledger().join(F.broadcast(updates.select("file_name")), "file_name", "left_anti")
    ledger = freeze(others.select(*LEDGER.names).unionByName(updates))
    table.apply(ledger, rows, updates, sorted({str(r[SNAPSHOT_DATE]) for r in named}), silver_schema(_layouts(ledger), family))
    return len(found)


def _layouts(ledger: DataFrame) -> list[list[str]]:
    """The distinct headers of the files that are there, in the order in which a build meets them."""
    live = ledger.where("NOT removed AND header IS NOT NULL")
    return [r["header"] for r in live.groupBy("header").agg(F.min("path").alias("p")).orderBy("p").collect()]


def refresh_silver(
    spark: SparkSession,
    folder: str,
    family: SnapshotFamily,
    target: str,
    files_per_batch: int = 1000,
) -> int:
    """Bring silver up to date with ``folder`` and return how many files were read.

    The folder is listed once and met with the ledger by a full outer join on the file name. New, late and restated
    files, told by time and length, replace exactly their own rows; emptied files lose them, and so do removed and
    renamed ones, of which the ledger keeps a tombstone. At most ``files_per_batch`` files are handled at once, in the
    order of their months; each such step is a committed version, so readers see whole months, old or new, and
    a run that fails in between is repeated from there by the next. A folder without any file of the family is an
    error, not an order to empty the table.
    """
    table = SilverTable(spark, target)
    plan = frozen_plan(list_snapshots(spark, folder, family), table)
    if plan.where("state NOT IN ('removed', 'gone')").isEmpty():
        raise FileNotFoundError(f"no {family.label} matching {family.file_pattern} in {folder}")
    pending = plan.where("state IN ('new', 'changed', 'removed')")
    total = pending.count()
    if total > files_per_batch:
        order = [SNAPSHOT_DATE, "file_name"]
        pending = freeze(rank_rows(pending, [F.col(c) for c in order], order, "_rank"))
    read = 0
    for done in range(0, total, files_per_batch):
        step = pending
        if total > files_per_batch:
            step = pending.where(F.col("_rank").between(done + 1, done + files_per_batch)).drop("_rank")
        read += _land(table, step, family)
    return read
