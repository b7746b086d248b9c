"""Manifests of a mirrored file tree: building, comparing, planning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.names import child_path, normalize_prefix, safe_name
from panelforge.operators.joins import attach
from panelforge.runtime import freeze, freeze_measured
from panelforge.schemas import columns

# Item kinds told apart by MIME type.
FOLDER_MIME = "application/vnd.google-apps.folder"
SHORTCUT_MIME = "application/vnd.google-apps.shortcut"
NATIVE_MIME_PREFIX = "application/vnd.google-apps."

# Fields of a manifest entry. Folders have neither size nor checksum.
ENTRY = columns(
    "type string, name string, relative_path string, s3_key string, parent_id string, "
    "mime_type string, size string, modified_time string, md5_checksum string"
)
MANIFEST = T.StructType([T.StructField("file_id", T.StringType()), *ENTRY.fields])

# Columns of a tree listing: the first parent only, ``can_download`` NULL meaning yes.
LISTING = columns(
    "file_id string, name string, parent_id string, mime_type string, size string, "
    "modified_time string, md5_checksum string, can_download boolean"
)


def item_kind(mime: Column, can_download: Column) -> Column:
    """``folder``, ``file`` or the reason an item is left out."""
    mime = F.coalesce(mime, F.lit(""))
    return (
        F.when(mime == FOLDER_MIME, F.lit("folder"))
        .when(mime == SHORTCUT_MIME, F.lit("skipped_shortcut"))
        .when(mime.startswith(NATIVE_MIME_PREFIX), F.lit("skipped_native"))
        .when(~F.coalesce(can_download, F.lit(True)), F.lit("skipped_not_downloadable"))
        .otherwise(F.lit("file"))
    )


def folder_paths(folders: DataFrame, root_id: str) -> DataFrame:
    """Path and depth of every folder (file_id, parent_id, name) below the root, as parent_id, base and depth.

    Pointer doubling: each folder knows an ancestor and the path from there; joined with the ancestor's own
    entry, it knows one twice as far, until that is the root. The rounds follow the logarithm of the depth.
    Folders whose ancestor is not listed drop out; a round in which no folder newly reaches the root leaves
    only circles.
    """
    state = folders.select(
        "file_id", F.col("parent_id").alias("up"), child_path(F.lit(""), F.col("name"), True).alias("base"), F.lit(1).alias("depth")
    )
    state, _, size = freeze_measured(state)
    at_root = F.col("up") == root_id
    done, todo = state.where(at_root), state.where(~at_root)
    reached = [done]
    while not done.isEmpty():
        above = state.select(
            F.col("file_id").alias("up"), F.col("up").alias("next"), F.col("base").alias("before"), F.col("depth").alias("steps")
        )
        further = attach(todo, above, ["up"], how="inner", side_bytes=size).select(
            "file_id",
            F.col("next").alias("up"),
            F.concat("before", "base").alias("base"),
            (F.col("depth") + F.col("steps")).alias("depth"),
        )
        moved, rows, size = freeze_measured(further)
        if not rows:
            break
        done, todo = moved.where(at_root), moved.where(~at_root)
        reached.append(done)
        # Whoever points to a folder that has reached the root reaches it next.
        state, size = state.where(at_root).unionByName(moved), 2 * size
    found = reached[0]
    for more in reached[1:]:
        found = found.unionByName(more)
    root = folders.sparkSession.createDataFrame([(root_id, "", 0)], "parent_id string, base string, depth int")
    return root.unionByName(found.select(F.col("file_id").alias("parent_id"), "base", "depth"))


def tree_paths(listing: DataFrame, root_id: str) -> DataFrame:
    """Every item reachable from the root, with kind, depth and relative path.

    Folders find their paths by ``folder_paths``; items are then joined once to their parent folder, in which
    a folder holding a third of all items is a hot key of ``attach``. Children of non-folders are unreachable.
    """
    # Written once: the folders and the last join read it.
    items = freeze(
        listing.withColumns(
            {
                "name": safe_name(F.col("name")),
                "kind": item_kind(F.col("mime_type"), F.col("can_download")),
            }
        )
    )
    # The root is a start, not an item: leaving it out also rules out walking in circles.
    folders = freeze(
        items.where((F.col("kind") == "folder") & (F.col("file_id") != root_id)).select(
            "file_id", "parent_id", "name"
        )
    )
    again = items.where(F.col("file_id") != root_id).groupBy("file_id", "kind").count().where("count > 1").first()
    if again:
        # Under two parents it would have two paths, of which the manifest can keep one only.
        raise ValueError(f"{again['kind']} {again['file_id']!r} is listed more than once")
    folder = F.col("kind") == "folder"
    path = F.when(folder, child_path(F.col("base"), F.col("name"), True)).otherwise(
        child_path(F.col("base"), F.col("name"), False)
    )
    return (
        attach(items, folder_paths(folders, root_id), ["parent_id"], how="inner")
        .withColumns({"relative_path": path, "depth": F.col("depth") + 1})
        .drop("base")
    )


def manifest_rows(tree: DataFrame, prefix: str) -> DataFrame:
    """Manifest entries of the folders and files in a walked tree."""
    is_file = F.col("kind") == "file"
    return tree.where(F.col("kind").isin("folder", "file")).select(
        "file_id",
        F.col("kind").alias("type"),
        "name",
        "relative_path",
        F.concat(F.lit(normalize_prefix(prefix)), F.col("relative_path")).alias("s3_key"),
        "parent_id",
        "mime_type",
        F.when(is_file, F.col("size")).alias("size"),
        "modified_time",
        F.when(is_file, F.col("md5_checksum")).alias("md5_checksum"),
    )


def crawl_counts(tree: DataFrame) -> DataFrame:
    """Folders, files and skipped items of a walked tree, one row."""
    kind = F.col("kind")
    return tree.agg(
        F.count_if(kind == "folder").alias("folders"),
        F.count_if(kind == "file").alias("files"),
        F.count_if(kind.startswith("skipped")).alias("skipped"),
    )


def shared_keys(manifest: DataFrame, key: str = "s3_key", item: str = "file_id") -> DataFrame:
    """Keys claimed by more than one item.

    Least and greatest item differ exactly when there are two or more, which combines on
    the map side where a distinct count per key would ship every pair.
    """
    return (
        manifest.groupBy(key)
        .agg(F.min(item).alias("first_id"), F.max(item).alias("last_id"))
        .where("first_id <> last_id")
    )


def require_unique_keys(manifest: DataFrame) -> DataFrame:
    clash = shared_keys(manifest).first()
    if clash:
        raise ValueError(
            f"items {clash['first_id']!r} and {clash['last_id']!r} share key {clash['s3_key']!r}"
        )
    return manifest


def needs_download(old_md5: Column, new_md5: Column, in_feed: Column) -> Column:
    """The bytes may differ: the item is in the change feed and the checksums are not both
    present and equal."""
    same = (old_md5 != "") & (old_md5 == new_md5)
    return in_feed & ~F.coalesce(same, F.lit(False))


def changed_ids(feed: DataFrame) -> DataFrame:
    """Item ids of a change feed. Repeats are left for ``diff`` to merge on the way."""
    return feed.where(F.col("fileId").isNotNull()).select(F.col("fileId").alias("file_id"))


def diff(old: DataFrame, new: DataFrame, changed: DataFrame) -> DataFrame:
    """One row per item id with its change type.

    The three inputs meet in one aggregation by id instead of two joins: a single exchange,
    combined on the map side, in which a repeated id cannot multiply.
    """
    compared = ["type", "s3_key", "relative_path", "md5_checksum"]
    entry = F.struct(*compared)
    none = F.lit(None).cast(old.select(entry.alias("e")).schema["e"].dataType)
    sides = (
        old.select("file_id", entry.alias("o"), none.alias("n"), F.lit(False).alias("feed"))
        .unionByName(
            new.select("file_id", none.alias("o"), entry.alias("n"), F.lit(False).alias("feed"))
        )
        .unionByName(
            changed.select("file_id", none.alias("o"), none.alias("n"), F.lit(True).alias("feed"))
        )
    )
    merged = sides.groupBy("file_id").agg(
        F.max("o").alias("o"), F.max("n").alias("n"), F.bool_or("feed").alias("in_feed")
    )
    old_key, new_key = F.col("o.s3_key"), F.col("n.s3_key")
    download = needs_download(F.col("o.md5_checksum"), F.col("n.md5_checksum"), F.col("in_feed"))
    fed_file = F.col("in_feed") & (F.col("n.type") == "file")
    change = (
        F.when(F.col("o").isNull(), F.lit("added"))
        .when(F.col("n").isNull(), F.lit("removed"))
        .when(~old_key.eqNullSafe(new_key), F.lit("moved"))
        .when(fed_file & download, F.lit("content_changed"))
        .when(fed_file, F.lit("metadata_only"))
        .otherwise(F.lit("unchanged"))
    )
    known = F.col("o").isNotNull() | F.col("n").isNotNull()
    return merged.where(known).select(
        "file_id",
        F.coalesce(F.col("n.type"), F.col("o.type")).alias("type"),
        change.alias("change_type"),
        old_key.alias("old_key"),
        new_key.alias("new_key"),
        F.col("n.relative_path").alias("relative_path"),
        F.coalesce(download, F.lit(False)).alias("download"),
    )


def cleanup(changes: DataFrame, new: DataFrame) -> DataFrame:
    """Old keys to delete: of removed and moved items, unless a current item owns the key."""
    return (
        changes.where(F.col("change_type").isin("removed", "moved"))
        .select("file_id", F.col("old_key").alias("s3_key"), F.col("change_type").alias("reason"))
        .join(new.select("s3_key"), "s3_key", "left_anti")
        .select("file_id", "s3_key", "reason")
    )


# Where one source of each circle of copies waits.
STAGING = ".staging/"


def move_order(after: DataFrame) -> DataFrame:
    """When to write each key whose present contents another step still has to read.

    ``after`` (file_id, next) says that file_id has to be written after ``next`` has been read; nobody follows two, and
    two follow nobody alike, so it is a set of chains and circles. Returns file_id, turn and first: a chain is written
    from its free end, whose turn is 0. In a circle the item with the least id is ``first``: its source is put
    aside, which makes a chain of the rest that ends in this item.

    Pointer doubling: the rounds follow the logarithm of the longest chain or circle.
    """
    zero = F.lit(0).cast("long")
    waiting = after.select(F.col("file_id").alias("_id"))
    state = after.join(waiting, F.col("next") == F.col("_id"), "left").select(
        "file_id",
        F.col("next").alias("up"),
        (zero + 1).alias("hops"),
        F.struct(F.col("file_id").alias("id"), zero.alias("far")).alias("least"),
        # A chain ends at an item that itself waits for nothing.
        F.col("_id").isNull().alias("ended"),
    )
    state = freeze(state)
    while True:
        ahead = state.select(*(F.col(c).alias(f"_{c}") for c in state.columns))
        smaller = F.col("_least.id") < F.col("least.id")
        seen = F.struct(F.col("_least.id").alias("id"), (F.col("_least.far") + F.col("hops")).alias("far"))
        state = freeze(
            state.drop("new")
            .join(ahead.drop("_new"), F.col("up") == F.col("_file_id"), "left")
            .select(
                "file_id",
                F.coalesce("_up", "up").alias("up"),
                (F.col("hops") + F.coalesce("_hops", zero)).alias("hops"),
                F.when(smaller, seen).otherwise(F.col("least")).alias("least"),
                (F.col("ended") | F.col("_ended")).alias("ended"),
                # Chains still grow ends, or circles still learn their least id.
                (~F.col("ended") & (F.col("_ended") | smaller)).alias("new"),
            )
        )
        if state.where("new").isEmpty():
            break
    circles = state.where("NOT ended")
    sizes = circles.groupBy(F.col("least.id").alias("least_id")).agg((F.max("least.far") + 1).alias("n"))
    turned = circles.select("file_id", F.col("least.id").alias("least_id"), F.col("least.far").alias("far")).join(sizes, "least_id")
    leader = F.col("far") == 0
    return state.where("ended").select("file_id", F.col("hops").alias("turn"), F.lit(False).alias("first")).unionByName(
        turned.select("file_id", F.when(leader, F.col("n") - 1).otherwise(F.col("far") - 1).alias("turn"), leader.alias("first"))
    )


def actions(changes: DataFrame, new: DataFrame | None = None, staging: str = STAGING) -> DataFrame:
    """What the mirror has to do, one row per step.

    ``step`` orders the steps, ``depth`` those of one step: folder markers, shallowest first, then new files,
    moved files, files changed in place, deletions. ``counts_as`` names the counters a step adds
    to; deleting the old key of a moved item adds to none.

    The mirror is changed while the steps run. A key that a copy still has to read is written after that copy
    (``move_order``), new files among the moved ones if need be. Of each circle of copies one source is
    staged first (step 0) under ``staging`` and its file id, the copy reads it there as the last of the circle, and it
    is unstaged at the end (step 6). An old key is deleted unless a current item owns it.

    Who owns the old keys now is one join, of the items that left their key with the items that have one.
    ``new`` is not needed any more, as ``changes`` names all current items.
    """
    folder = F.col("type") == "folder"
    kind = F.col("change_type")
    step = (
        F.when(folder & kind.isin("added", "moved"), F.lit(1))
        .when(~folder & (kind == "added"), F.lit(2))
        .when(~folder & (kind == "moved"), F.lit(3))
        .when(kind == "content_changed", F.lit(4))
    )
    verb = (
        F.when(step == 1, F.lit("mark_folder"))
        .when((step == 3) & ~F.col("download"), F.lit("copy"))
        .otherwise(F.lit("download"))
    )
    counters = F.concat_ws(
        ",",
        F.when(verb == "download", F.lit("downloaded")),
        F.when(kind == "moved", F.lit("moved")),
        F.when((step == 1) & (kind == "added"), F.lit("folder_markers_created")),
    )
    depth = F.when(step == 1, F.regexp_count("relative_path", F.lit("/"))).otherwise(F.lit(0))
    planned = freeze(
        changes.select(
            "file_id", kind.alias("change_type"), "old_key", "new_key", step.alias("step"), depth.alias("depth"),
            F.when(step.isNotNull(), verb).alias("action"), counters.alias("counts_as"),
        )
    )
    left = planned.where(F.col("change_type").isin("removed", "moved"))
    owners = planned.where("new_key IS NOT NULL").select(
        F.col("file_id").alias("owner"), F.col("new_key").alias("old_key"), F.col("step").alias("owner_step")
    )
    owned = freeze(
        left.select("file_id", "old_key", "action").join(owners, "old_key").select("file_id", "old_key", "action", "owner", "owner_step")
    )
    none = F.lit(None).cast("string")
    deletions = left.join(owned.select("file_id"), "file_id", "left_anti").select(
        "file_id",
        F.lit(5).alias("step"),
        F.lit(0).alias("depth"),
        F.lit("delete").alias("action"),
        none.alias("source_key"),
        F.col("old_key").alias("s3_key"),
        F.when(F.col("change_type") == "removed", F.lit("deleted")).otherwise(F.lit("")).alias("counts_as"),
    )
    copied = F.when(F.col("action") == "copy", F.col("old_key"))
    upserts = planned.where("step IS NOT NULL")
    waits = owned.where("action = 'copy' AND owner_step IN (2, 3)")
    shape = ["file_id", "step", "depth", "action", "source_key", "s3_key", "counts_as"]
    if waits.isEmpty():
        return upserts.select(
            "file_id", "step", "depth", "action", copied.alias("source_key"), F.col("new_key").alias("s3_key"), "counts_as"
        ).unionByName(deletions)

    turns = freeze(move_order(waits.select(F.col("owner").alias("file_id"), F.col("file_id").alias("next"))))
    staged = F.concat(F.lit(staging), "file_id")
    first = F.coalesce("first", F.lit(False))
    steps = upserts.join(turns, "file_id", "left").select(
        "file_id",
        F.when(F.col("turn").isNotNull(), 3).otherwise(F.col("step")).alias("step"),
        F.coalesce(F.col("turn").cast("int"), "depth").alias("depth"),
        "action",
        F.when(first, staged).otherwise(copied).alias("source_key"),
        F.col("new_key").alias("s3_key"),
        "counts_as",
    )
    aside = planned.join(turns.where("first").select("file_id"), "file_id", "left_semi")

    def extra(step: int, action: str, source: Column) -> DataFrame:
        return aside.select(
            "file_id",
            F.lit(step).alias("step"),
            F.lit(0).alias("depth"),
            F.lit(action).alias("action"),
            source.alias("source_key"),
            staged.alias("s3_key"),
            F.lit("").alias("counts_as"),
        )

    return (
        steps.unionByName(deletions)
        .unionByName(extra(0, "stage", F.col("old_key")))
        .unionByName(extra(6, "unstage", none))
        .select(shape)
    )


def in_step_order(steps: DataFrame) -> DataFrame:
    """An action table in the order a sequential executor has to follow."""
    return steps.orderBy("step", "depth", "file_id")


def plan_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change_type").agg(F.count(F.lit(1)).alias("items"))


def run_counts(steps: DataFrame) -> DataFrame:
    """Run counters of a finished action table, one row."""
    names = ["downloaded", "moved", "deleted", "folder_markers_created"]
    counted = F.split("counts_as", ",")
    return steps.agg(*(F.count_if(F.array_contains(counted, n)).alias(n) for n in names))
