"""One run of an incremental mirror, as a plan over tables.

Copying bytes is left to the caller: it gets the action table and reports failure by
raising, in which case no state advances and the next run sees the same changes again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.names import normalize_prefix
from panelforge.operators.manifest import (
    MANIFEST,
    actions,
    changed_ids,
    crawl_counts,
    diff,
    manifest_rows,
    plan_counts,
    require_unique_keys,
    run_counts,
    tree_paths,
)
from panelforge.runtime import freeze, freeze_measured
from panelforge.sources.state import SCHEMA_VERSION, StateStore

APPLICABLE = ("added", "moved", "removed", "content_changed")


@dataclass(frozen=True)
class MirrorRun:
    """What one run decided. Tables are None where the run had no need of them."""

    mode: str
    change_records: int = 0
    crawl: DataFrame | None = None
    plan: DataFrame | None = None
    steps: DataFrame | None = None
    counts: DataFrame | None = None


def bootstrap_steps(manifest: DataFrame) -> DataFrame:
    """Everything is new: folder markers by depth, then files."""
    nothing = manifest.limit(0)
    return actions(diff(nothing, manifest, nothing.select("file_id")), manifest)


def _walk(listing: DataFrame, root_id: str, prefix: str) -> tuple[DataFrame, DataFrame]:
    tree = freeze(tree_paths(listing, root_id))
    manifest = require_unique_keys(manifest_rows(tree, prefix).select(*MANIFEST.names))
    return manifest, crawl_counts(tree)


def mirror(
    store: StateStore,
    root_id: str,
    prefix: str,
    listing: Callable[[], DataFrame],
    feed: DataFrame | None,
    cursor: Callable[[], str],
    apply: Callable[[DataFrame], None],
) -> MirrorRun:
    """Bring the mirror up to date and advance the state.

    The next cursor is taken before the tree is listed, so that a change made during the
    listing is seen again by the next run rather than lost. ``apply`` gets the action
    table; ``in_step_order`` sorts it for a sequential executor.
    """
    state = store.read()
    next_token = cursor()
    if state is None:
        manifest, crawl = _walk(listing(), root_id, prefix)
        steps = freeze(bootstrap_steps(manifest))
        apply(steps)
        store.commit(root_id, next_token, manifest)
        return MirrorRun("bootstrap", crawl=crawl, steps=steps, counts=run_counts(steps))

    if state.folder_id != root_id:
        raise ValueError(f"the saved state belongs to folder {state.folder_id!r}")
    # Read once: what is counted is what is planned from, even if the feed grows meanwhile.
    feed, records, _ = freeze_measured(feed.select("fileId"))
    if not records:
        manifest, crawl = None, None
        if state.schema_version < SCHEMA_VERSION:
            manifest, crawl = _walk(listing(), root_id, prefix)
        store.commit(root_id, next_token, manifest, after=state)
        return MirrorRun("no_changes", crawl=crawl)

    manifest, crawl = _walk(listing(), root_id, prefix)
    changes = freeze(diff(state.manifest, manifest, changed_ids(feed)))
    plan = plan_counts(changes)
    if changes.where(F.col("change_type").isin(*APPLICABLE)).isEmpty():
        store.commit(root_id, next_token, manifest, after=state)
        return MirrorRun("no_applicable_changes", records, crawl, plan)

    # Two mirrors of one bucket, or two runs, do not meet in one staging place.
    run_id = hashlib.sha256(next_token.encode()).hexdigest()[:12]
    steps = freeze(actions(changes, manifest, f"{normalize_prefix(prefix)}.staging-{run_id}/"))
    apply(steps)
    store.commit(root_id, next_token, manifest, after=state)
    return MirrorRun("incremental", records, crawl, plan, steps, run_counts(steps))
