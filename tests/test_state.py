"""Exclusive commits and retention of the mirror state."""

from __future__ import annotations

import pytest

from panelforge.operators.manifest import FOLDER_MIME, LISTING, MANIFEST
from panelforge.plans.mirror import mirror
from panelforge.sources.files import names_in
from panelforge.sources.state import ConcurrentCommit, StateStore
from panelforge.streaming.feed import CHANGE


def manifest(spark, *ids):
    rows = [(i, "file", i, i, f"p/{i}", "root", "t", "1", "now", "m") for i in ids]
    return spark.createDataFrame(rows, MANIFEST)


def ids(state):
    return sorted(r["file_id"] for r in state.manifest.collect())


def test_of_two_interleaved_commits_the_second_fails(spark, tmp_path):
    store, other = (StateStore(spark, str(tmp_path)) for _ in range(2))
    store.commit("root", "t0", manifest(spark, "a"))
    mine, theirs = store.read(), other.read()
    other.commit("root", "t1", manifest(spark, "b"), after=theirs)
    for late in (manifest(spark, "c"), None):
        with pytest.raises(ConcurrentCommit):
            store.commit("root", "t2", late, after=mine)
    state = store.read()
    assert state.page_token == "t1" and ids(state) == ["b"]
    assert len(names_in(spark, f"{tmp_path}/manifest")) == 2


def test_two_first_runs(spark, tmp_path, monkeypatch):
    store, other = (StateStore(spark, str(tmp_path)) for _ in range(2))
    monkeypatch.setattr(other, "_cursors", lambda: [])
    store.commit("root", "t0", manifest(spark, "a"))
    with pytest.raises(ConcurrentCommit):
        other.commit("root", "t9", manifest(spark, "z"))
    assert ids(store.read()) == ["a"]


def test_the_last_two_versions_stay(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    for k in range(4):
        store.commit("root", f"t{k}", manifest(spark, f"f{k}"))
    for k in range(4, 6):
        store.commit("root", f"t{k}")
    assert names_in(spark, f"{tmp_path}/cursor") == ["version=4", "version=5"]
    # Both cursors name the manifest of version 3.
    assert [n.split("-")[0] for n in names_in(spark, f"{tmp_path}/manifest")] == ["version=3"]
    assert ids(store.read()) == ["f3"] and store.read().page_token == "t5"


def test_a_run_that_was_overtaken_leaves_the_other_state(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    folder = ("d", "d", "root", FOLDER_MIME, None, "t", None, True)

    def listing(*names):
        files = [(n, n, "d", "text/csv", "1", "t", "m", True) for n in names]
        return lambda: spark.createDataFrame([folder, *files], LISTING)

    feed = spark.createDataFrame([("x", False, "t")], CHANGE)
    mirror(store, "root", "p", listing("a"), None, lambda: "t0", lambda steps: None)

    def overtaken(steps):
        mirror(StateStore(spark, str(tmp_path)), "root", "p", listing("a", "b"), feed, lambda: "t1", lambda steps: None)

    with pytest.raises(ConcurrentCommit):
        mirror(store, "root", "p", listing("a", "c"), feed, lambda: "t2", overtaken)
    assert store.read().page_token == "t1" and ids(store.read()) == ["a", "b", "d"]
