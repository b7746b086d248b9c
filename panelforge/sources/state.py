"""Versioned mirror state: a manifest table and the cursor that commits it."""

from __future__ import annotations

import datetime
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.operators.manifest import ENTRY, MANIFEST
from panelforge.schemas import columns
from panelforge.sources.files import create_once, delete, hadoop_path, path_exists
from panelforge.sources.gold import in_order

# Fixed value: schema version whose manifests carry checksums.
SCHEMA_VERSION = 2

# Fields of the JSON state documents.
MANIFEST_DOCUMENT = T.StructType(
    [
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("folder_id", T.StringType()),
        T.StructField("generated_at", T.StringType()),
        T.StructField("items", T.MapType(T.StringType(), ENTRY)),
    ]
)
CURSOR = columns(
    "folder_id string, page_token string, last_successful_run string, "
    "bootstrap_completed boolean, schema_version int, manifest_version long, manifest_folder string"
)
# Committed versions that stay; earlier ones are deleted.
KEPT_VERSIONS = 2


class ConcurrentCommit(RuntimeError):
    """Another run committed the version that this one was about to."""


def read_manifest_document(spark: SparkSession, path: str) -> DataFrame | None:
    """Manifest rows of one JSON state document, with its schema version; None if absent.

    For taking over existing state: a JSON document can only be parsed as a whole, so the
    state kept here is a Parquet table instead.
    """
    if not path_exists(spark, path):
        return None
    document = spark.read.schema(MANIFEST_DOCUMENT).option("multiLine", "true").json(path)
    return document.select(
        F.coalesce("schema_version", F.lit(1)).alias("schema_version"),
        "folder_id",
        F.explode("items").alias("file_id", "entry"),
    ).select("schema_version", "folder_id", "file_id", "entry.*")


def write_manifest_json(manifest: DataFrame, path: str) -> None:
    """Manifest rows as JSON lines in id order, split over files."""
    fields = manifest.select(*MANIFEST.names)
    in_order(fields, ["file_id"]).write.mode("overwrite").json(path)


def read_manifest_json(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).json(path)


@dataclass(frozen=True)
class State:
    """Committed state: the cursor fields and the manifest they point to."""

    folder_id: str
    page_token: str
    schema_version: int
    manifest_version: int
    manifest: DataFrame
    version: int


class StateStore:
    """Manifests and cursors in numbered folders under ``base``.

    A commit writes the manifest first, into a folder of its own, and the cursor last, as one file that must not
    exist yet. Whatever fails in between leaves the previous cursor, and so the previous manifest, in force; of two
    runs that commit one version, the second fails and changes nothing. The last two versions stay.
    """

    def __init__(self, spark: SparkSession, base: str):
        self.spark = spark
        self.base = base.rstrip("/")

    def _versions(self, kind: str, mark: str) -> list[int]:
        pattern, fs = hadoop_path(self.spark, f"{self.base}/{kind}/version=*/{mark}")
        names = {f.getPath().getParent().getName() for f in fs.globStatus(pattern) or []}
        return sorted(int(n.split("=")[1].split("-")[0]) for n in names)

    def _cursors(self) -> list[int]:
        return self._versions("cursor", "*.json")

    def _cursor(self, version: int):
        return self.spark.read.schema(CURSOR).json(f"{self.base}/cursor/version={version}").first()

    def _manifest_path(self, cursor) -> str:
        folder = cursor["manifest_folder"] or f"version={cursor['manifest_version']}"
        return f"{self.base}/manifest/{folder}"

    def read(self) -> State | None:
        """The committed state, None before the first run. Half a state is an error."""
        cursors, manifests = self._cursors(), self._versions("manifest", "_SUCCESS")
        if not cursors and not manifests:
            return None
        if not cursors or not manifests:
            there = "manifest" if manifests else "cursor"
            raise RuntimeError(
                f"inconsistent state in {self.base}: only the {there} exists; restore the "
                "other or remove it to start over"
            )
        row = self._cursor(cursors[-1])
        if not row["page_token"]:
            raise ValueError(f"the cursor in {self.base} has no page token")
        manifest = self.spark.read.schema(MANIFEST).parquet(self._manifest_path(row))
        return State(
            row["folder_id"], row["page_token"], row["schema_version"] or 1,
            row["manifest_version"], manifest, cursors[-1],
        )

    def commit(
        self,
        folder_id: str,
        page_token: str,
        manifest: DataFrame | None = None,
        schema_version: int = SCHEMA_VERSION,
        after: State | None = None,
    ) -> None:
        """Advance the cursor, with a new manifest or keeping the current one.

        ``after`` is the state this run started from; its version is then the one that must still be the newest.
        """
        cursors = self._cursors()
        last = after.version if after else cursors[-1] if cursors else -1
        version = last + 1
        if manifest is None:
            kept = self._cursor(last)
            manifest_version, folder = kept["manifest_version"], kept["manifest_folder"]
        else:
            manifest_version, folder = version, f"version={version}-{uuid.uuid4().hex}"
            manifest.select(*MANIFEST.names).write.parquet(f"{self.base}/manifest/{folder}")
        now = datetime.datetime.now(datetime.timezone.utc).isoformat()
        values = (folder_id, page_token, now, True, schema_version, manifest_version, folder)
        cursor = {name: value for name, value in zip(CURSOR.names, values) if value is not None}
        if not create_once(self.spark, f"{self.base}/cursor/version={version}/cursor.json", json.dumps(cursor) + "\n"):
            if manifest is not None:
                delete(self.spark, f"{self.base}/manifest/{folder}")
            raise ConcurrentCommit(f"version {version} of {self.base} was committed by another run")
        self._retire([*cursors, version])

    def _retire(self, cursors: list[int]) -> None:
        """Drop all but the newest versions and the manifests that only these named."""
        old = cursors[:-KEPT_VERSIONS]
        kept = {self._manifest_path(self._cursor(v)) for v in cursors[-KEPT_VERSIONS:]} if old else set()
        for version in old:
            path = self._manifest_path(self._cursor(version))
            if path not in kept:
                delete(self.spark, path)
            delete(self.spark, f"{self.base}/cursor/version={version}")
