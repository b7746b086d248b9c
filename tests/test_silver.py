"""The silver table: headers, reconciliation, versions, misfitting records."""

from __future__ import annotations

import os
import time

import pytest

from panelforge.functions.dictionaries import FACILITY
from panelforge.sources.files import FIRST_BYTES, create_once, first_lines, names_in
from panelforge.sources.silver import ConcurrentCommit, SilverTable
from panelforge.sources.snapshots import build_silver, headers, read_silver, rejected_rows, write_silver
from panelforge.streaming.snapshots import refresh_silver

HEAD = "CMS Certification Number (CCN),Provider Name,State,Processing Date,Average Number of Residents per Day"


def put(folder, month, *rows, head=HEAD):
    folder.mkdir(exist_ok=True)
    path = folder / f"NH_ProviderInfo_{month}.csv"
    path.write_text("\n".join([head, *(r if isinstance(r, str) else f"{r},a,AL,1/1/2024,1" for r in rows)]) + "\n")
    return path


def content(df):
    columns = sorted(c for c in df.columns if c != "SILVER_PROCESSED_AT")
    return columns, sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def same_as_batch(spark, source, target):
    return content(read_silver(spark, str(target))) == content(build_silver(spark, str(source), FACILITY))


# ---- headers


def test_only_the_first_bytes_of_a_file_are_read(spark, tmp_path):
    small, large = tmp_path / "small.csv", tmp_path / "large.csv"
    small.write_text(HEAD + "\n1,a\n")
    large.write_text(HEAD + "\n" + "1,a,AL,1/1/2024,1\n" * 400_000)
    one, other = first_lines(spark, [str(small), str(large)])
    assert one.text == other.text == HEAD and other.bytes_read <= FIRST_BYTES < large.stat().st_size


def test_long_blank_and_unfinished_first_lines(spark, tmp_path):
    wide = ",".join(f"Column {k}" for k in range(5000))
    texts = [wide + "\nx", "", "\n\r\n  \nA,B\r\n1,2", "A,B", "﻿A,é\n", "A,B\r1,2\r", "x" * FIRST_BYTES + "\n1", "x" * FIRST_BYTES]
    paths = []
    for k, text in enumerate(texts):
        paths.append(str(tmp_path / f"{k}.csv"))
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
    got = headers(spark, paths)
    assert got[0][-1] == "Column 4999" and len(got[0]) == 5000
    assert got[1:6] == [(), ("A", "B"), ("A", "B"), ("A", "é"), ("A", "B")]
    assert got[6] == got[7] == ("x" * FIRST_BYTES,)


def test_many_small_files_take_no_job_and_little_time(spark, tmp_path):
    for k in range(192):
        put(tmp_path / "in", f"Jan{1800 + k}", k)
    paths = sorted(str(p) for p in (tmp_path / "in").iterdir())
    spark.sparkContext.setJobGroup("first lines", "")
    began = time.perf_counter()
    assert len(set(headers(spark, paths))) == 1
    assert time.perf_counter() - began < 3
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("first lines")


# ---- reconciliation


def test_removed_renamed_shrunk_and_returning_files(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    refresh = lambda: refresh_silver(spark, str(source), FACILITY, str(target), 2)
    put(source, "Oct2024", 1, 2)
    put(source, "October2024", 3)
    put(source, "Nov2024", 4, 5)
    put(source, "Dec2024", 6)
    assert refresh() == 4 and same_as_batch(spark, source, target)
    (source / "NH_ProviderInfo_Oct2024.csv").unlink()
    assert refresh() == 0 and same_as_batch(spark, source, target)
    assert read_silver(spark, str(target)).count() == 4
    os.rename(source / "NH_ProviderInfo_Nov2024.csv", source / "NH_ProviderInfo_November2024.csv")
    assert refresh() == 1 and same_as_batch(spark, source, target)
    put(source, "November2024", 5)
    assert refresh() == 1 and same_as_batch(spark, source, target)
    back = put(source, "Oct2024", 1, 2)
    assert refresh() == 1 and same_as_batch(spark, source, target)
    ledger = {r["file_name"]: r for r in SilverTable(spark, str(target)).ledger().collect()}
    assert {n for n, r in ledger.items() if r["removed"]} == {"NH_ProviderInfo_Nov2024.csv"}
    assert ledger[back.name]["rows"] == 2 and ledger[back.name]["header"][0].startswith("CMS")
    assert refresh() == 0
    for path in source.iterdir():
        path.unlink()
    with pytest.raises(FileNotFoundError):
        refresh()
    assert read_silver(spark, str(target)).count() == 5


def test_columns_follow_the_files_that_are_there(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put(source, "Oct2024", 1)
    wide = put(source, "Nov2024", "x,2,b,TX,1/2/2024,3", head="Brand New," + HEAD)
    refresh_silver(spark, str(source), FACILITY, str(target))
    assert "BRAND_NEW" in read_silver(spark, str(target)).columns and same_as_batch(spark, source, target)
    wide.unlink()
    refresh_silver(spark, str(source), FACILITY, str(target))
    assert "BRAND_NEW" not in read_silver(spark, str(target)).columns and same_as_batch(spark, source, target)


def test_the_folder_is_listed_once(spark, tmp_path, monkeypatch):
    from panelforge.streaming import snapshots

    listed = []
    monkeypatch.setattr(snapshots, "list_snapshots", lambda *a, f=snapshots.list_snapshots: listed.append(a) or f(*a))
    for k in range(5):
        put(tmp_path / "in", f"Jan{2000 + k}", k)
    assert refresh_silver(spark, str(tmp_path / "in"), FACILITY, str(tmp_path / "out"), 2) == 5
    assert len(listed) == 1 and SilverTable(spark, str(tmp_path / "out")).version().number == 2


# ---- versions


def test_a_reader_keeps_its_version_during_a_refresh(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    put(source, "Oct2024", 1, 2)
    put(source, "Nov2024", 3)
    refresh_silver(spark, str(source), FACILITY, str(target))
    reading = read_silver(spark, str(target))
    put(source, "Oct2024", 7, 8, 9)
    refresh_silver(spark, str(source), FACILITY, str(target))
    assert sorted(r["CCN"] for r in reading.collect()) == ["1", "2", "3"]
    assert sorted(r["CCN"] for r in read_silver(spark, str(target)).collect()) == ["3", "7", "8", "9"]
    # The month that was not touched is where it was.
    old, new = (SilverTable(spark, str(target)).version(n).months for n in (0, 1))
    assert old["2024-11-01"] == new["2024-11-01"] and old["2024-10-01"] != new["2024-10-01"]


def test_versions_before_the_last_two_go(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    for k in range(5):
        put(source, "Oct2024", *range(k + 1))
        refresh_silver(spark, str(source), FACILITY, str(target))
    assert names_in(spark, f"{target}/_versions") == ["0000000003.json", "0000000004.json"]
    assert len(names_in(spark, f"{target}/data")) == len(names_in(spark, f"{target}/_ledger")) == 2
    assert read_silver(spark, str(target)).count() == 5


def test_the_second_of_two_writers_fails(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    put(source, "Oct2024", 1)
    silver = build_silver(spark, str(source), FACILITY)
    write_silver(silver, target)
    late = SilverTable(spark, target)
    seen = late.version()
    late.version = lambda number=None: seen
    write_silver(silver.unionAll(silver), target)
    with pytest.raises(ConcurrentCommit):
        late.replace_all(silver)
    assert read_silver(spark, target).count() == 2
    assert len(names_in(spark, f"{target}/data")) == 2


def test_an_interrupted_write_leaves_the_old_version(spark, tmp_path, monkeypatch):
    source, target = tmp_path / "in", tmp_path / "out"
    put(source, "Oct2024", 1)
    refresh_silver(spark, str(source), FACILITY, str(target))
    put(source, "Oct2024", 1, 2)
    monkeypatch.setattr(SilverTable, "_counted", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        refresh_silver(spark, str(source), FACILITY, str(target))
    assert read_silver(spark, str(target)).count() == 1
    monkeypatch.undo()
    assert refresh_silver(spark, str(source), FACILITY, str(target)) == 1 and same_as_batch(spark, source, target)


def test_a_month_filter_reads_one_folder(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    for month in ("Oct2024", "Nov2024", "Dec2024"):
        put(source, month, 1)
    write_silver(build_silver(spark, str(source), FACILITY), target)
    one = read_silver(spark, target).where("SNAPSHOT_DATE = DATE'2024-11-01'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(SNAPSHOT_DATE" in plan and one.count() == 1


def test_create_once(spark, tmp_path):
    path = str(tmp_path / "sub" / "one")
    assert create_once(spark, path, "first") and not create_once(spark, path, "second")
    assert (tmp_path / "sub" / "one").read_text() == "first"
    assert names_in(spark, str(tmp_path / "sub")) == ["one"]


# ---- misfitting records


def test_misfitting_records_are_kept_and_reported(spark, tmp_path):
    source, target = tmp_path / "in", str(tmp_path / "out")
    put(source, "Oct2024", 1, "2,b", "3,c,NY,1/1/2024,1,extra,more", '4,"d, e",AL,1/1/2024,1')
    put(source, "Nov2024", 5)
    refresh_silver(spark, str(source), FACILITY, target)
    assert same_as_batch(spark, source, target) and read_silver(spark, target).count() == 5
    assert "_RAW_RECORD" not in read_silver(spark, target).columns
    got = sorted((r["SOURCE_FILE_NAME"], r["RECORD"]) for r in rejected_rows(spark, target).collect())
    assert got == [("NH_ProviderInfo_Oct2024.csv", "2,b"), ("NH_ProviderInfo_Oct2024.csv", "3,c,NY,1/1/2024,1,extra,more")]
    counts = {r["file_name"]: (r["rows"], r["malformed"]) for r in SilverTable(spark, target).ledger().collect()}
    assert counts == {"NH_ProviderInfo_Oct2024.csv": (4, 2), "NH_ProviderInfo_Nov2024.csv": (1, 0)}
    # Rows carried over to a rewritten month keep their mark.
    put(source, "October2024", 9)
    refresh_silver(spark, str(source), FACILITY, target)
    assert rejected_rows(spark, target).count() == 2
