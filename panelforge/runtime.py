"""Sessions and reliable scratch tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Scratch paths of the innermost open scope.
_SCOPE: ContextVar[list[str] | None] = ContextVar("panelforge_scratch", default=None)


def local_session(cores: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session for tests and benchmarks. On a cluster, use the session you are given."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": memory,
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("panelforge")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix="panelforge-")


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's checkpoint folder.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local path would be lost with the executor, so a missing setting is an error.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = _local_root(context.applicationId)
    return f"{root.rstrip('/')}/panelforge-{context.applicationId}"


def scratch_path(spark: SparkSession, label: str = "table") -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    scope = _SCOPE.get()
    if scope is not None:
        scope.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession):
    """Delete on exit the scratch tables written inside. For jobs whose results are written
    elsewhere by then."""
    paths: list[str] = []
    before = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(before)
        for path in paths:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def drop_scratch(spark: SparkSession) -> None:
    """Delete every scratch table this application wrote. Call when a job is finished."""
    _delete(spark, scratch_root(spark))


def freeze(df: DataFrame) -> DataFrame:
    """Write ``df`` once as a Parquet scratch table and read it back.

    Cuts the lineage, so the rows are the same for every later use and a lost executor
    costs a re-read, not a recomputation. Column pruning and filters still reach the scan.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def freeze_measured(df: DataFrame) -> tuple[DataFrame, int, int]:
    """``freeze`` plus the exact row count and an upper bound of the in-memory bytes.

    Both numbers are observed while the table is written, so there is no second pass.
    """
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) + 16
        for f in df.schema.fields
    ]
    watch = Observation()
    frozen = freeze(
        df.observe(
            watch,
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(sum(widths, F.lit(0))), F.lit(0)).alias("bytes"),
        )
    )
    seen = watch.get
    return frozen, seen["rows"], seen["bytes"]
