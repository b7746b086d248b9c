"""Chains, circles and deep trees."""

from __future__ import annotations

import random

import pytest

from panelforge.operators.manifest import (
    FOLDER_MIME,
    LISTING,
    MANIFEST,
    actions,
    changed_ids,
    diff,
    folder_paths,
    in_step_order,
    move_order,
    tree_paths,
)
from panelforge.runtime import freeze


def jobs_writing(monkeypatch):
    """Counts tables written by the manifest operators."""
    from panelforge.operators import manifest

    seen = []
    monkeypatch.setattr(manifest, "freeze_measured", lambda df, f=manifest.freeze_measured: seen.append(1) or f(df))
    monkeypatch.setattr(manifest, "freeze", lambda df, f=freeze: seen.append(1) or f(df))
    return seen


def test_turns_of_chains_and_circles(spark, monkeypatch):
    """Every length from 1 to 9 of both, and a chain and a circle of 300, in logarithmically many rounds."""
    rng, pairs, chains, circles = random.Random(3), [], {}, []
    names = [f"n{k:05d}" for k in range(2000)]
    rng.shuffle(names)
    for length in [*range(1, 10)] * 3 + [300]:
        path = [names.pop() for _ in range(length + 1)]
        pairs += zip(path, path[1:])
        chains |= {item: length - k for k, item in enumerate(path[:-1])}
        circle = [names.pop() for _ in range(length + 1)]
        pairs += zip(circle, [*circle[1:], circle[0]])
        circles.append(circle)
    written = jobs_writing(monkeypatch)
    got = {r["file_id"]: (r["turn"], r["first"]) for r in move_order(spark.createDataFrame(pairs, "file_id string, next string")).collect()}
    assert len(written) <= 12
    assert len(got) == len(pairs) and all(got[i] == (turn, False) for i, turn in chains.items())
    for circle in circles:
        k = circle.index(min(circle))
        turned = [*circle[k + 1 :], *circle[: k + 1]]
        # The item before the one put aside comes first, that one itself last.
        order = sorted(circle, key=lambda i: got[i][0])
        assert order == [*reversed(turned[:-1]), turned[-1]] and [i for i in circle if got[i][1]] == [min(circle)]


def carried_out(steps, store):
    """The steps one by one on a store of bytes; a copy reads what is there at its time."""
    for s in steps:
        if s["action"] in ("copy", "stage"):
            store[s["s3_key"]] = store[s["source_key"]]
        elif s["action"] == "download":
            store[s["s3_key"]] = (s["file_id"], "new")
        elif s["action"] == "mark_folder":
            store[s["s3_key"]] = (s["file_id"], "folder")
        else:
            store.pop(s["s3_key"])
    return store


def circles_of(old, new, copies) -> int:
    """Closed rounds of copies among the moved items."""
    by_old = {old[i]: i for i in copies}
    found = set()
    for i in copies:
        walk, at = [], i
        while at in copies and at not in walk:
            walk.append(at)
            at = by_old.get(new[at])
        if at == i:
            found.add(frozenset(walk))
    return len(found)


@pytest.mark.parametrize("seed", range(8))
def test_plans_end_in_the_new_contents(spark, seed):
    """Swaps, chains, reused keys, folders, contents changed in place and on the way."""
    rng = random.Random(seed)
    ids, keys = [f"f{i}" for i in range(14)], [f"k{i}" for i in range(11)]
    folders, places = [f"d{i}" for i in range(4)], [f"p{i}/" for i in range(4)]
    sides = [
        dict(zip(rng.sample(ids, 10), rng.sample(keys, 10))) | dict(zip(rng.sample(folders, 3), rng.sample(places, 3))) for _ in range(2)
    ]
    fed = set(rng.sample(ids, 5))
    changed = {i for i in fed if rng.random() < 0.6}

    def frame(side, new):
        rows = [
            (i, "folder" if i[0] == "d" else "file", i, k, k, "root", "t", "1", "now",
             None if i[0] == "d" else "m2" if new and i in changed else "m1")
            for i, k in side.items()
        ]
        return spark.createDataFrame(rows, MANIFEST)

    old, new = sides
    feed = spark.createDataFrame([(i,) for i in fed], "fileId string")
    steps = in_step_order(actions(diff(frame(old, False), frame(new, True), changed_ids(feed)))).collect()
    store = carried_out(steps, {k: (i, "folder" if i[0] == "d" else "old") for i, k in old.items()})
    want = {}
    for i, k in new.items():
        kept = i in old and i not in changed
        want[k] = (i, "folder" if i[0] == "d" else "old" if kept else "new")
    assert store == want
    copies = {i for i in ids if i in old and i in new and old[i] != new[i] and i not in changed}
    assert sum(s["action"] == "stage" for s in steps) == circles_of(old, new, copies)


def listing(spark, rows):
    return spark.createDataFrame([(*r, None, "t", None, True) for r in rows], LISTING)


def test_a_chain_of_500_folders_takes_few_rounds(spark, monkeypatch):
    rows = [(f"d{k}", f"n{k}", f"d{k - 1}" if k else "root", FOLDER_MIME) for k in range(500)]
    rows += [("c1", "c", "c2", FOLDER_MIME), ("c2", "c", "c1", FOLDER_MIME), ("in", "i", "c1", FOLDER_MIME)]
    rows += [("f", "leaf", "d499", "text/csv"), ("lost", "x", "in", "text/csv"), ("o", "orphan", "nowhere", FOLDER_MIME)]
    written = jobs_writing(monkeypatch)
    tree = tree_paths(listing(spark, rows), "root")
    assert len(written) <= 12 + 3
    got = {r["file_id"]: (r["depth"], r["relative_path"]) for r in tree.collect()}
    assert len(got) == 501
    assert got["f"] == (501, "".join(f"n{k}/" for k in range(500)) + "leaf") and got["d0"] == (1, "n0/")


@pytest.mark.parametrize("seed", range(3))
def test_random_trees(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(300):
        parent = rng.choice(["root", *(f"d{j}" for j in range(max(k - 5, 0), k))])
        rows.append((f"d{k}", f"n{k}", parent, FOLDER_MIME))
    want, parents = {}, {r[0]: r for r in rows}
    for r in rows:
        names, at = [], r[0]
        while at != "root":
            names.append(parents[at][1])
            at = parents[at][2]
        want[r[0]] = ("".join(f"{n}/" for n in reversed(names)), len(names))
    frame = spark.createDataFrame([(r[0], r[2], r[1]) for r in rows], "file_id string, parent_id string, name string")
    got = {r["parent_id"]: (r["base"], r["depth"]) for r in folder_paths(frame, "root").collect()}
    assert got == want | {"root": ("", 0)}


def test_a_file_listed_under_two_parents_is_an_error(spark):
    rows = [("a", "a", "root", FOLDER_MIME), ("b", "b", "root", FOLDER_MIME), ("f", "f", "a", "text/csv"), ("f", "f", "b", "text/csv")]
    with pytest.raises(ValueError, match="file 'f' is listed more than once"):
        tree_paths(listing(spark, rows), "root")
