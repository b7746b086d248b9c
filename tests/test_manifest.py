"""Manifest building, comparison, state and the mirror runs."""

from __future__ import annotations

import functools
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from panelforge.operators.joins import attach
from panelforge.operators.manifest import (
    FOLDER_MIME,
    LISTING,
    MANIFEST,
    SHORTCUT_MIME,
    actions,
    changed_ids,
    cleanup,
    diff,
    in_step_order,
    manifest_rows,
    require_unique_keys,
    run_counts,
    tree_paths,
)
from panelforge.plans.mirror import mirror
from panelforge.sources.state import (
    StateStore,
    path_exists,
    read_manifest_document,
    read_manifest_json,
    write_manifest_json,
)
from panelforge.streaming.feed import CHANGE, feed_stream


def entry(file_id, key, md5="m", kind="file"):
    return (file_id, kind, file_id, key, "p/" + key, "root", "t", "1", "now", md5)


def manifest(spark, *entries):
    return spark.createDataFrame(list(entries), MANIFEST)


def feed(spark, *ids):
    return spark.createDataFrame([(i, False, "t") for i in ids], CHANGE)


def changes(spark, old, new, *fed):
    return diff(manifest(spark, *old), manifest(spark, *new), changed_ids(feed(spark, *fed)))


def kinds(spark, old, new, *fed):
    return {r.file_id: (r.change_type, r.download) for r in changes(spark, old, new, *fed).collect()}


CASES = [
    ([], [entry("a", "k")], [], ("added", False)),
    ([entry("a", "k")], [], [], ("removed", False)),
    ([entry("a", "k")], [entry("a", "k2")], ["a", "a"], ("moved", False)),
    ([entry("a", "k")], [entry("a", "k2", "x")], ["a"], ("moved", True)),
    ([entry("a", "k")], [entry("a", "k2", "x")], [], ("moved", False)),
    ([entry("a", "k")], [entry("a", "k", "x")], ["a"], ("content_changed", True)),
    ([entry("a", "k")], [entry("a", "k")], ["a"], ("metadata_only", False)),
    ([entry("a", "k", None)], [entry("a", "k")], ["a"], ("content_changed", True)),
    ([entry("a", "k", "")], [entry("a", "k", "")], ["a"], ("content_changed", True)),
    ([entry("a", "k")], [entry("a", "k", "x")], [], ("unchanged", False)),
]


@pytest.mark.parametrize("old, new, fed, expected", CASES)
def test_change_types(spark, old, new, fed, expected):
    got = kinds(spark, old, new, *fed)["a"]
    assert got[0] == expected[0]
    if expected[0] not in ("added", "removed"):
        assert got[1] == expected[1]


def test_same_path_folder_in_feed_is_unchanged(spark):
    folder = entry("d", "k/", None, "folder")
    assert kinds(spark, [folder], [folder], "d")["d"][0] == "unchanged"


def test_unknown_ids_in_feed_are_ignored(spark):
    assert kinds(spark, [entry("a", "k")], [entry("a", "k")], "zz", None) == {"a": ("unchanged", False)}


def test_swapped_keys_are_not_deleted(spark):
    old, new = [entry("a", "1"), entry("b", "2")], [entry("a", "2"), entry("b", "1")]
    swapped = changes(spark, old, new, "a", "b")
    assert {r.change_type for r in swapped.collect()} == {"moved"}
    assert cleanup(swapped, manifest(spark, *new)).count() == 0


def test_reused_key_is_not_deleted(spark):
    old, new = [entry("a", "1"), entry("b", "2")], [entry("c", "1")]
    left = cleanup(changes(spark, old, new), manifest(spark, *new)).collect()
    assert [(r.file_id, r.s3_key, r.reason) for r in left] == [("b", "p/2", "removed")]


def test_actions_and_counts(spark):
    old = [entry("f", "old/", None, "folder"), entry("m", "old/x"), entry("r", "r"), entry("c", "c"),
           entry("md", "old/y")]
    new = [entry("f", "new/", None, "folder"), entry("m", "new/x"), entry("n", "a/b/n"),
           entry("nf", "a/b/", None, "folder"), entry("c", "c", "z"), entry("md", "new/y", "w")]
    table = manifest(spark, *new)
    steps = actions(changes(spark, old, new, "m", "c", "md"), table)
    got = {(r.file_id, r.action): (r.step, r.depth, r.source_key) for r in steps.collect()}
    ordered = [(r.step, r.depth) for r in in_step_order(steps).collect()]
    assert ordered == sorted(ordered)
    assert got == {
        ("f", "mark_folder"): (1, 1, None), ("nf", "mark_folder"): (1, 2, None),
        ("n", "download"): (2, 0, None), ("m", "copy"): (3, 0, "p/old/x"),
        ("md", "download"): (3, 0, None), ("c", "download"): (4, 0, None),
        ("f", "delete"): (5, 0, None), ("m", "delete"): (5, 0, None), ("r", "delete"): (5, 0, None),
        ("md", "delete"): (5, 0, None),
    }
    assert run_counts(steps).first().asDict() == {
        "downloaded": 3, "moved": 3, "deleted": 1, "folder_markers_created": 1
    }


side = st.dictionaries(
    st.sampled_from("abcdef"), st.tuples(st.sampled_from("123"), st.sampled_from([None, "", "x", "y"]))
)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=side, new=side, fed=st.sets(st.sampled_from("abcdefz")))
def test_diff_against_sets(spark, old, new, fed):
    rows = [[entry(i, k, m) for i, (k, m) in d.items()] for d in (old, new)]
    got = {i: kind for i, (kind, _) in kinds(spark, *rows, *fed).items()}
    expected = {}
    for i in old.keys() | new.keys():
        if i not in old:
            expected[i] = "added"
        elif i not in new:
            expected[i] = "removed"
        elif old[i][0] != new[i][0]:
            expected[i] = "moved"
        elif i not in fed:
            expected[i] = "unchanged"
        else:
            same = bool(old[i][1]) and old[i][1] == new[i][1]
            expected[i] = "metadata_only" if same else "content_changed"
    assert got == expected


def item(file_id, name, parent, mime="text/csv", download=None):
    return (file_id, name, parent, mime, "1", "now", "m", download)


TREE = [
    item("d1", "a/b", "root", FOLDER_MIME), item("d2", "inner", "d1", FOLDER_MIME),
    item("d3", "empty", "d2", FOLDER_MIME), item("f0", "top.csv", "root"),
    item("f1", "x\\y.csv", "d2"), item("s", "link", "d1", SHORTCUT_MIME),
    item("under", "lost.csv", "s"), item("g", "doc", "d1", "application/vnd.google-apps.document"),
    item("no", "locked", "d1", download=False), item("yes", "open", "d1", download=True),
    item("c1", "circle", "c2", FOLDER_MIME), item("c2", "circle", "c1", FOLDER_MIME),
    item("o", "orphan", "nowhere"), item("root", "self", "d1", FOLDER_MIME),
]


def listing(spark, rows=TREE):
    return spark.createDataFrame(rows, LISTING)


@pytest.mark.parametrize("limit", [1 << 20, -1])
def test_tree_walk(spark, monkeypatch, limit):
    narrow = functools.partial(attach, broadcast_bytes=limit)
    monkeypatch.setattr("panelforge.operators.manifest.attach", narrow)
    tree = tree_paths(listing(spark), "root")
    got = {r.file_id: (r.kind, r.depth, r.relative_path) for r in tree.collect() if r.file_id != "root"}
    assert got == {
        "d1": ("folder", 1, "a_b/"), "d2": ("folder", 2, "a_b/inner/"),
        "d3": ("folder", 3, "a_b/inner/empty/"), "f0": ("file", 1, "top.csv"),
        "f1": ("file", 3, "a_b/inner/x_y.csv"), "s": ("skipped_shortcut", 2, "a_b/link"),
        "g": ("skipped_native", 2, "a_b/doc"), "no": ("skipped_not_downloadable", 2, "a_b/locked"),
        "yes": ("file", 2, "a_b/open"),
    }
    keys = {r.file_id: r.s3_key for r in manifest_rows(tree, "/bronze/").collect()}
    assert keys["d1"] == "bronze/a_b/" and keys["f1"] == "bronze/a_b/inner/x_y.csv"
    assert "s" not in keys


def test_two_items_one_key(spark):
    with pytest.raises(ValueError, match="share key 'p/k'"):
        require_unique_keys(manifest(spark, entry("a", "k"), entry("b", "k")))


def test_json_state(spark, tmp_path):
    document = {
        "schema_version": 1, "folder_id": "root", "generated_at": "t",
        "items": {
            "a": {"type": "file", "name": "a", "relative_path": "a", "s3_key": "p/a", "size": "1"},
            "d": {"type": "folder", "name": "d", "relative_path": "d/", "s3_key": "p/d/"},
        },
    }
    file = tmp_path / "manifest.json"
    file.write_text(json.dumps(document, indent=1))
    rows = read_manifest_document(spark, str(file)).orderBy("file_id").collect()
    assert [(r.file_id, r.type, r.md5_checksum, r.schema_version) for r in rows] == [
        ("a", "file", None, 1), ("d", "folder", None, 1)
    ]
    assert read_manifest_document(spark, str(tmp_path / "absent.json")) is None
    table = manifest(spark, entry("b", "2"), entry("a", "1", None))
    write_manifest_json(table, str(tmp_path / "lines"))
    back = read_manifest_json(spark, str(tmp_path / "lines"))
    assert [tuple(r) for r in back.collect()] == [entry("a", "1", None), entry("b", "2")]


def run(spark, store, rows=TREE, fed=(), token="t1", apply=lambda steps: None, root="root"):
    order = []

    def cursor():
        order.append("cursor")
        return token

    def listed():
        order.append("listing")
        return listing(spark, rows)

    done = mirror(store, root, "p", listed, feed(spark, *fed), cursor, apply)
    assert order[0] == "cursor"
    return done


def no_cycle(rows):
    return [r for r in rows if r[0] != "root"]


BASE = no_cycle(TREE)


def test_mirror_life(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    first = run(spark, store, BASE)
    assert first.mode == "bootstrap"
    assert first.counts.first().asDict() == {
        "downloaded": 3, "moved": 0, "deleted": 0, "folder_markers_created": 3
    }
    assert first.crawl.first().asDict() == {"folders": 3, "files": 3, "skipped": 3}

    idle = run(spark, store, BASE, token="t2")
    assert idle.mode == "no_changes" and store.read().page_token == "t2"
    assert run(spark, store, BASE, ["elsewhere"], "t3").mode == "no_applicable_changes"

    renamed = [("d1", "moved", *r[2:]) if r[0] == "d1" else r for r in BASE if r[0] != "f0"]

    def fail(steps):
        raise OSError("store down")

    with pytest.raises(OSError):
        run(spark, store, renamed, ["d1", "f0"], "t4", apply=fail)
    assert store.read().page_token == "t3"
    again = run(spark, store, renamed, ["d1", "f0"], "t4")
    assert again.mode == "incremental" and again.change_records == 2
    assert again.counts.first().asDict() == {
        "downloaded": 0, "moved": 5, "deleted": 1, "folder_markers_created": 0
    }
    assert store.read().page_token == "t4"
    with pytest.raises(ValueError, match="belongs to"):
        run(spark, store, root="other")


def test_half_state_is_an_error(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    manifest(spark).write.parquet(f"{tmp_path}/manifest/version=0")
    with pytest.raises(RuntimeError, match="only the manifest"):
        store.read()


def test_old_schema_is_upgraded_without_actions(spark, tmp_path):
    store = StateStore(spark, str(tmp_path))
    store.commit("root", "t0", manifest(spark, entry("f0", "top.csv", None)), schema_version=1)

    def never(steps):
        raise AssertionError("no action expected")

    assert run(spark, store, BASE, token="t1", apply=never).mode == "no_changes"
    state = store.read()
    assert state.schema_version == 2
    assert state.manifest.where("file_id = 'f0'").first().md5_checksum == "m"


def test_feed_stream(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "state"))
    folder = tmp_path / "feed"
    folder.mkdir()
    seen = []

    def go():
        feed_stream(
            spark, str(folder), store, "root", "p", lambda: listing(spark, BASE),
            lambda steps: seen.append(steps.count()), str(tmp_path / "chk"),
        ).awaitTermination()

    (folder / "1.json").write_text('{"fileId": "f0", "removed": false, "time": "t"}\n')
    go()
    assert seen == [6] and store.read().page_token.endswith(":0")
    (folder / "2.json").write_text('{"fileId": "f0", "removed": false, "time": "t"}\n')
    go()
    go()
    assert seen == [6] and store.read().page_token.endswith(":1")
    assert path_exists(spark, str(tmp_path / "state" / "cursor" / "version=1"))
