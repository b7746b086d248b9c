"""Incremental runs on inputs that come late, change, go empty or trade places."""

from __future__ import annotations

import os
import random

import pytest

from panelforge.functions.dictionaries import FACILITY
from panelforge.operators.manifest import LISTING, actions, diff, in_step_order, tree_paths
from panelforge.sources.snapshots import build_silver, list_snapshots, read_silver, resolve, silver
from panelforge.sources.state import StateStore
from panelforge.streaming.feed import feed_stream
from panelforge.streaming.snapshots import refresh_silver, snapshot_stream
from panelforge.workload.oracles import ORACLES

HEAD = "CMS Certification Number (CCN),Provider Name,State,Processing Date,Average Number of Residents per Day"
COLUMNS = ["CCN", "STATE", "SOURCE_FILE_NAME", "SNAPSHOT_DATE"]


def put(folder, month, *rows, days=0):
    folder.mkdir(exist_ok=True)
    path = folder / f"NH_ProviderInfo_{month}.csv"
    path.write_text("\n".join([HEAD, *(f"{r},a,AL,1/1/2024,1" for r in rows)]) + "\n")
    then = path.stat().st_mtime - days * 86_400
    os.utime(path, (then, then))
    return path


def same_as_batch(spark, source, target):
    got = read_silver(spark, str(target)).select(*COLUMNS)
    batch = build_silver(spark, str(source), FACILITY).select(*COLUMNS)
    return sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_refresh_follows_the_folder(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    refresh = lambda: refresh_silver(spark, str(source), FACILITY, str(target), 2)
    put(source, "Oct2024", 1, 2)
    assert refresh() == 1 and refresh() == 0
    put(source, "Sep2024", 3, days=30)
    put(source, "Aug2024", 4, days=400)
    put(source, "Jul2024", 5)
    assert refresh() == 3 and same_as_batch(spark, source, target)
    put(source, "Oct2024", 1, 7, 8)
    assert refresh() == 1 and same_as_batch(spark, source, target)
    put(source, "Sep2024", days=3)
    assert refresh() == 1 and same_as_batch(spark, source, target)
    assert refresh() == 0 and read_silver(spark, str(target)).count() == 5


def test_stream_reads_old_files(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"

    def run():
        snapshot_stream(spark, str(source), FACILITY, str(target), str(tmp_path / "chk")).awaitTermination()

    put(source, "Oct2024", 1)
    run()
    put(source, "Sep2024", 2, days=30)
    run()
    assert same_as_batch(spark, source, target)


def test_headers_take_one_job_for_any_number_of_files(spark, tmp_path):
    def jobs(n):
        for k in range(n):
            put(tmp_path / f"in{n}", f"Jan{1800 + k}", k)
        found = resolve(list_snapshots(spark, str(tmp_path / f"in{n}"), FACILITY), FACILITY, "here")
        spark.sparkContext.setJobGroup(f"headers{n}", "")
        silver(spark, found, FACILITY)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers{n}"))

    # Above 32 paths Spark lists them in jobs of its own, as many for any number.
    assert jobs(3) <= 2 and jobs(40) == jobs(60) <= 4


def test_names_with_spaces_and_doubled_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    name = "NH_ProviderInfo_Oct2024.csv"
    (tmp_path / "in" / name).write_text('﻿"CMS Certification Number (CCN)",Provider Name,State,Processing Date,'
                                        'Average Number of Residents per Day,X,x\n1,"a, b",AL,1/1/2024,1,p,q\n')
    row = build_silver(spark, str(tmp_path / "in"), FACILITY).first()
    assert (row["CCN"], row["PROVIDER_NAME"], row["X5"], row["X6"]) == ("1", "a, b", "p", "q")


def test_a_new_checkpoint_acts_on_all_records(spark, tmp_path):
    store, folder, seen = StateStore(spark, str(tmp_path / "state")), tmp_path / "feed", []
    folder.mkdir()
    rows = [("d", "d", "root", "application/vnd.google-apps.folder", None, "t", None, True)]

    def listing(md5):
        return spark.createDataFrame([*rows, ("f", "f", "d", "text/csv", "1", "t", md5, True)], LISTING)

    def go(checkpoint, md5):
        feed_stream(
            spark, str(folder), store, "root", "p", lambda: listing(md5), lambda steps: seen.append(steps.count()), str(tmp_path / checkpoint)
        ).awaitTermination()

    (folder / "1.json").write_text('{"fileId": "f", "removed": false, "time": "t"}\n')
    go("one", "m1")
    go("one", "m1")
    assert seen == [2]
    go("two", "m2")
    assert seen == [2, 1] and store.read().manifest.where("file_id = 'f'").first().md5_checksum == "m2"


def test_steps_end_in_the_new_contents(spark):
    """Swaps, chains and reused keys, carried out one by one on a store of bytes."""
    rng = random.Random(1)
    kinds = "file_id string, type string, s3_key string, relative_path string, md5_checksum string"

    def frame(places):
        return spark.createDataFrame([(i, "file", k, k, "m") for i, k in places.items()], kinds)

    cases = [({"a": "x", "b": "y", "c": "z"}, {"a": "y", "b": "x", "c": "w", "d": "z"})]
    for _ in range(6):
        ids, keys = [f"f{i}" for i in range(12)], [f"k{i}" for i in range(9)]
        cases.append(tuple(dict(zip(rng.sample(ids, 8), rng.sample(keys, 8))) for _ in range(2)))
    for old, new in cases:
        before, after = frame(old), frame(new)
        steps = in_step_order(actions(diff(before, after, before.select("file_id").limit(0)), after)).collect()
        store = {k: i for i, k in old.items()}
        for s in steps:
            if s["action"] in ("copy", "stage"):
                store[s["s3_key"]] = store[s["source_key"]]
            elif s["action"] == "download":
                store[s["s3_key"]] = s["file_id"]
            else:
                store.pop(s["s3_key"])
        assert store == {k: i for i, k in new.items()}


def test_a_folder_listed_twice_ends_the_walk(spark):
    mime = "application/vnd.google-apps.folder"
    rows = [("a", "a", "root", mime), ("b", "b", "a", mime), ("a", "a", "b", mime)]
    listed = spark.createDataFrame([(*r, None, "t", None, True) for r in rows], LISTING)
    with pytest.raises(ValueError, match="'a' is listed more than once"):
        tree_paths(listed, "root")


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_no_oracle_is_empty(sf):
    from oracle import connect

    con = connect(f"/root/testdata/sf{sf}")
    empty = [name for name in ("detail_unpivot", "mirror_swaps", "scope_filter", "strength_label") if not con.sql(ORACLES[name]).fetchall()]
    assert empty == []
