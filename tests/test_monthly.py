"""Metrics kept up by touched months: equal to a full build, nothing else rewritten."""

from __future__ import annotations

import datetime
import os

import pytest

from panelforge.plans import metrics
from panelforge.sources.monthly import TABLES, TURNOVER_SUMS, MonthlyMetrics, merged_turnover
from panelforge.sources.silver import RAW, ConcurrentCommit, SilverTable

SCHEMA = (
    "CCN string, PROVIDER_NAME string, STATE string, SNAPSHOT_DATE date, NUMBER_OF_CERTIFIED_BEDS double, "
    "AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY double, REPORTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY double, "
    f"TOTAL_NURSING_STAFF_TURNOVER double, REGISTERED_NURSE_TURNOVER double, SOURCE_FILE_NAME string, {RAW} string"
)


def month(n):
    return datetime.date(2023 + (n - 1) // 12, (n - 1) % 12 + 1, 1)


def rows(spark, months, shift=0.0):
    states = ("AL", "TX", None)
    return spark.createDataFrame(
        [
            (str(k), f"p{k}", states[k % 3], month(m), 10.0 * k or None, 5.0 + k, 1.0, None if k % 4 == 0 else k + m + shift, shift + k, f"f{m}", None)
            for m in months for k in range(9)
        ],
        SCHEMA,
    )


def plain(df):
    columns = sorted(df.columns)
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=str
    )


def same_as_full(kept, silver):
    recent = metrics.facility_panel(silver.read()).withColumnRenamed("SNAPSHOT_DATE", "MONTH")
    for name, build in TABLES.items():
        assert plain(kept.read(name, None)) == plain(build(recent)), name


def test_a_refresh_rewrites_touched_months_only(spark, tmp_path):
    silver, kept = SilverTable(spark, str(tmp_path / "silver")), MonthlyMetrics(spark, str(tmp_path / "gold"))
    silver.replace_all(rows(spark, range(1, 6)))
    assert len(kept.refresh(silver)) == 5
    same_as_full(kept, silver)
    assert kept.refresh(silver) == [] and kept.version().number == 0
    first = kept.version().months

    before = silver.version()
    silver.commit(before, rows(spark, [2, 6], 0.5), before.schema, [str(month(2)), str(month(3))], None)
    assert kept.refresh(silver) == [str(month(2)), str(month(6))]
    same_as_full(kept, silver)
    now = kept.version().months
    assert {m for m in now if first.get(m) == now[m]} == {str(month(n)) for n in (1, 4, 5)}
    (new,) = set(now.values()) - set(first.values())
    for name in TABLES:
        folders = os.listdir(tmp_path / "gold" / name / f"write={new}")
        assert sorted(f for f in folders if f.startswith("MONTH")) == [f"MONTH={month(n)}" for n in (2, 6)]

    # A month that leaves silver leaves here, without a write; the window follows the newest month.
    before = silver.version()
    silver.commit(before, None, before.schema, [str(month(6))], None)
    assert kept.refresh(silver) == []
    same_as_full(kept, silver)
    assert {r["MONTH"] for r in kept.read(TURNOVER_SUMS, 2).collect()} == {month(4), month(5)}
    assert "write=" + new in os.listdir(tmp_path / "gold" / TURNOVER_SUMS)


def test_sums_merge_to_means_of_rows(spark, tmp_path):
    silver, kept = SilverTable(spark, str(tmp_path / "silver")), MonthlyMetrics(spark, str(tmp_path / "gold"))
    silver.replace_all(rows(spark, range(1, 4)))
    kept.refresh(silver)
    table, sums = rows(spark, range(1, 4)), kept.read(TURNOVER_SUMS)
    for keys in (["STATE"], [], ["SNAPSHOT_DATE"]):
        means = table.groupBy(*keys).agg({"TOTAL_NURSING_STAFF_TURNOVER": "avg", "REGISTERED_NURSE_TURNOVER": "avg"})
        by = ["MONTH" if k == "SNAPSHOT_DATE" else k for k in keys]
        got = merged_turnover(sums, by).select(*by, "REGISTERED_NURSE_TURNOVER", "TOTAL_NURSING_STAFF_TURNOVER")
        want = means.select(*keys, "avg(REGISTERED_NURSE_TURNOVER)", "avg(TOTAL_NURSING_STAFF_TURNOVER)")
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, want.collect())))


def test_a_second_writer_fails_and_odd_dates_are_refused(spark, tmp_path, monkeypatch):
    silver, kept = SilverTable(spark, str(tmp_path / "silver")), MonthlyMetrics(spark, str(tmp_path / "gold"))
    with pytest.raises(FileNotFoundError):
        kept.refresh(silver)
    silver.replace_all(rows(spark, [1]))
    late = MonthlyMetrics(spark, kept.path)
    monkeypatch.setattr(late, "version", lambda number=None: None)
    kept.refresh(silver)
    with pytest.raises(ConcurrentCommit):
        late.refresh(silver)
    assert len(os.listdir(tmp_path / "gold" / TURNOVER_SUMS)) == 1
    silver.replace_all(rows(spark, [1]).selectExpr("* except (SNAPSHOT_DATE)", "date'2023-01-15' AS SNAPSHOT_DATE"))
    with pytest.raises(ValueError, match="2023-01-15"):
        kept.refresh(silver)
