"""Snapshot files: discovery, drift, typing, streaming."""

from __future__ import annotations

import datetime

import pytest

from panelforge.functions.dictionaries import FACILITY, MEASURES
from panelforge.operators.contracts import normalize_columns
from panelforge.sources.snapshots import (
    build_silver,
    discover,
    read_silver,
    read_snapshots,
    write_silver,
)
from panelforge.streaming.snapshots import snapshot_stream

D = datetime.date
HEAD = "CMS Certification Number (CCN),Provider Name,State,Processing Date,ZIP Code"


def put(folder, month, text, stem="NH_ProviderInfo"):
    file = folder / f"{stem}_{month}.csv"
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text)
    return file


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def test_discovery(spark, tmp_path):
    put(tmp_path, "Oct2024", HEAD + "\n")
    put(tmp_path, "November2024", HEAD + "\n")
    (tmp_path / "nh_providerinfo_DEC2024.CSV").write_text(HEAD + "\n")
    put(tmp_path / "sub", "Jan2024", HEAD + "\n")
    put(tmp_path / "key=1", "Feb2024", HEAD + "\n")
    put(tmp_path, "Oct24", HEAD + "\n")
    put(tmp_path, "Oct2024", HEAD + "\n", stem="Other")
    found = discover(spark, str(tmp_path), FACILITY)
    assert [(f.name, f.month) for f in found] == [
        ("NH_ProviderInfo_November2024.csv", D(2024, 11, 1)),
        ("NH_ProviderInfo_Oct2024.csv", D(2024, 10, 1)),
        ("nh_providerinfo_DEC2024.CSV", D(2024, 12, 1)),
    ]


def test_discovery_errors(spark, tmp_path):
    put(tmp_path, "Oct2024", "a\n", stem="Other")
    with pytest.raises(FileNotFoundError):
        discover(spark, str(tmp_path), FACILITY)
    put(tmp_path, "Foo2024", HEAD + "\n")
    with pytest.raises(ValueError, match="NH_ProviderInfo_Foo2024.csv"):
        discover(spark, str(tmp_path), FACILITY)


def test_reordered_extra_and_missing_columns(spark, tmp_path):
    put(tmp_path, "Oct2024", HEAD + '\n015009,"Say ""hi"", home",AL,10/01/2024,"35653"\n')
    put(
        tmp_path, "Nov2024",
        "State,Brand New,Provider Name,CMS Certification Number (CCN)\nTX, raw ,Home,015010\n"
        "NY,short\n",
    )
    with pytest.warns(UserWarning, match="BRAND_NEW"):
        silver = build_silver(spark, str(tmp_path), FACILITY)
    assert silver.columns == [
        "STATE", "BRAND_NEW", "PROVIDER_NAME", "CCN", "SOURCE_FILE_NAME", "SNAPSHOT_DATE",
        "PROCESSING_DATE", "ZIP_CODE", "SILVER_PROCESSED_AT",
    ]
    assert dict(silver.dtypes)["ZIP_CODE"] == "double"
    assert rows(
        silver, "CCN", "PROVIDER_NAME", "STATE", "PROCESSING_DATE", "ZIP_CODE", "BRAND_NEW",
        "SOURCE_FILE_NAME", "SNAPSHOT_DATE",
    ) == sorted(
        [
            ("015009", 'Say "hi", home', "AL", D(2024, 10, 1), 35653.0, None,
             "NH_ProviderInfo_Oct2024.csv", D(2024, 10, 1)),
            ("015010", "Home", "TX", None, None, " raw ", "NH_ProviderInfo_Nov2024.csv",
             D(2024, 11, 1)),
            (None, None, "NY", None, None, "short", "NH_ProviderInfo_Nov2024.csv", D(2024, 11, 1)),
        ],
        key=str,
    )


def test_same_header_is_one_scan(spark, tmp_path):
    for month in ("Jan2024", "Feb2024", "Mar2024"):
        put(tmp_path, month, HEAD + "\n1,a,AL,1/1/2024,1\n")
    put(tmp_path, "Apr2024", "State,ZIP Code\nAL,2\n")
    files = discover(spark, str(tmp_path), FACILITY)
    plan = read_snapshots(spark, files, FACILITY)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 2


def test_header_collision_and_reserved_name(spark, tmp_path):
    put(tmp_path / "a", "Oct2024", "A b,A-b\n1,2\n")
    with pytest.raises(ValueError, match="A_B"):
        build_silver(spark, str(tmp_path / "a"), FACILITY)
    put(tmp_path / "b", "Oct2024", "CCN,snapshot date\n1,2\n")
    with pytest.raises(ValueError, match="SNAPSHOT_DATE"):
        build_silver(spark, str(tmp_path / "b"), FACILITY)
    with pytest.raises(ValueError, match="X_Y"):
        normalize_columns(spark.createDataFrame([(1, 2)], "`x y` int, `x-y` int"))


def test_measure_files(spark, tmp_path):
    stem = "Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data"
    put(
        tmp_path, "Oct2024",
        "CMS Certification Number (CCN),Measure Code,Score,Footnote,Start Date,End Date\n"
        '015009,S_1, Not Available ,"9,13",01/01/2023,12/31/2023\n',
        stem=stem,
    )
    silver = build_silver(spark, str(tmp_path), MEASURES)
    assert rows(silver, "CCN", "SCORE", "FOOTNOTE", "START_DATE", "END_DATE") == [
        ("015009", "Not Available", "9,13", D(2023, 1, 1), D(2023, 12, 31))
    ]
    put(tmp_path, "Nov2024", HEAD + "\n", stem=stem)
    with pytest.raises(ValueError, match="MEASURE_CODE"):
        build_silver(spark, str(tmp_path), MEASURES)


def test_write_reports_in_one_pass(spark, tmp_path):
    put(tmp_path / "in", "Oct2024", HEAD + "\n1,a,AL,1/1/2024,1\n2,b,AL,1/1/2024,1\n")
    report = write_silver(build_silver(spark, str(tmp_path / "in"), FACILITY), str(tmp_path / "out"))
    assert (report["rows"], report["columns"]) == (2, 8)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2


def test_stream_equals_batch(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))

    def run():
        snapshot_stream(spark, source, FACILITY, target, checkpoint).awaitTermination()

    columns = ["CCN", "STATE", "SOURCE_FILE_NAME", "SNAPSHOT_DATE"]
    put(tmp_path / "in", "Sep2024", HEAD + "\n1,a,AL,1/1/2024,1\n")
    run()
    put(tmp_path / "in" / "sub", "Jan2024", HEAD + "\n9,z,AL,1/1/2024,1\n")
    put(tmp_path / "in" / "key=1", "Feb2024", HEAD + "\n9,z,AL,1/1/2024,1\n")
    put(tmp_path / "in", "Oct2024", "State,CCN,New One\nTX,2,n\n")
    put(tmp_path / "in", "October2024", HEAD + "\n3,c,NY,1/1/2024,1\n")
    run()
    run()
    streamed = read_silver(spark, target)
    batch = build_silver(spark, source, FACILITY)
    assert set(streamed.columns) == set(batch.columns)
    assert dict(streamed.dtypes) == dict(batch.dtypes)
    assert rows(streamed, *columns, "NEW_ONE") == rows(batch, *columns, "NEW_ONE")
    assert streamed.count() == 3


def test_stream_names_the_bad_file(spark, tmp_path):
    put(tmp_path / "in", "Foo2024", HEAD + "\n")
    query = snapshot_stream(
        spark, str(tmp_path / "in"), FACILITY, str(tmp_path / "out"), str(tmp_path / "chk")
    )
    with pytest.raises(Exception, match="Foo2024"):
        query.awaitTermination()


def test_every_dictionary_column(spark, tmp_path):
    sample = {"text": " t ", "yes_no": "y", "date": "1/5/2024", "number": "52.1%"}
    names = list(FACILITY.kinds)
    put(
        tmp_path, "Oct2024",
        ",".join(n.replace("_", " ").title() for n in names) + "\n"
        + ",".join(sample[FACILITY.kinds[n]] for n in names) + "\n",
    )
    silver = build_silver(spark, str(tmp_path), FACILITY)
    kinds = {"text": "string", "yes_no": "string", "date": "date", "number": "double"}
    assert {n: t for n, t in silver.dtypes if n in FACILITY.kinds} == {
        n: kinds[k] for n, k in FACILITY.kinds.items()
    }
    clean = {"text": "t", "yes_no": "Y", "date": D(2024, 1, 5), "number": 52.1}
    assert silver.select(*names).first().asDict() == {n: clean[FACILITY.kinds[n]] for n in names}
