"""Metric tables and dashboard questions on hand-made panels."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from panelforge.operators.contracts import (
    DASHBOARD_SCHEMAS,
    FACILITY_PANEL,
    GOLD,
    MEASURE_TABLE,
    OCCUPANCY,
    STAFFING,
    TOTAL_TURNOVER,
    conform,
    require_columns,
)
from panelforge.operators.panel import latest_snapshot, lookback, lookback_start
from panelforge.plans import dashboard, metrics
from panelforge.sources.gold import load_dashboard, read_gold

D = datetime.date
OCT = D(2024, 10, 1)
CODE = metrics.READMISSION_MEASURE


def panel(spark, *rows):
    """Rows as (ccn, state, snapshot, beds, residents, staffing, total, rn)."""
    full = [(r[0], f"Home {r[0]}", *r[1:]) for r in rows]
    return spark.createDataFrame(full, FACILITY_PANEL)


def facility(ccn, state="AL", day=OCT, beds=100.0, residents=80.0, hours=3.0, total=50.0, rn=40.0):
    return (ccn, state, day, beds, residents, hours, total, rn)


def measures(spark, *rows):
    return spark.createDataFrame(list(rows), MEASURE_TABLE)


def score(ccn, value, end=OCT, snap=OCT, code=CODE):
    return (ccn, code, value, end - datetime.timedelta(365) if end else None, end, snap)


def test_lookback_window(spark):
    df = panel(spark, *(facility(str(m), day=D(2023, m, 1)) for m in (10, 11, 12)), facility("1"),
               facility("n", day=None))
    latest = latest_snapshot(df)
    assert latest == OCT
    kept = {r.SNAPSHOT_DATE for r in lookback(df, latest, 12).collect()}
    assert kept == {D(2023, 11, 1), D(2023, 12, 1), OCT}
    assert [r.MONTH for r in lookback(df, latest, 1).collect()] == [OCT]
    with pytest.raises(ValueError, match="SNAPSHOT_DATE"):
        latest_snapshot(df.where("SNAPSHOT_DATE IS NULL"))


@pytest.mark.parametrize("day", [OCT, D(2024, 3, 31), D(2024, 12, 31), D(2024, 1, 1)])
@pytest.mark.parametrize("months", [1, 2, 12, 26])
def test_lookback_start_is_add_months(spark, day, months):
    expected = spark.range(1).select(F.add_months(F.lit(day), 1 - months)).first()[0]
    assert lookback_start(day, months) == expected


def test_contracts(spark):
    df = panel(spark, facility("1"))
    with pytest.raises(ValueError, match="CCN"):
        require_columns(df.drop("CCN"), FACILITY_PANEL.names, "facility silver")
    texty = df.withColumns(
        {"NUMBER_OF_CERTIFIED_BEDS": F.lit("Not Available"), "SNAPSHOT_DATE": F.lit("bad")}
    )
    row = conform(texty, FACILITY_PANEL, "facility silver").first()
    assert row.NUMBER_OF_CERTIFIED_BEDS is None and row.SNAPSHOT_DATE is None
    numeric = df.withColumn("CCN", F.lit(15009))
    assert conform(numeric, FACILITY_PANEL, "facility silver").first().CCN == "15009"


def test_ranking(spark):
    df = panel(
        spark, facility("b", hours=2.0), facility("a", hours=2.0), facility("c", "TX", hours=1.0),
        facility("x", hours=None), facility("old", day=D(2024, 9, 1), hours=0.1),
        facility("n", None, hours=0.5), facility("m", None, hours=4.0),
    )
    rows = metrics.low_staffing(df, OCT, slices=3).orderBy("NATIONAL_RANK").collect()
    assert [(r.CCN, r.NATIONAL_RANK, r.STATE_RANK) for r in rows] == [
        ("n", 1, 1), ("c", 2, 1), ("a", 3, 1), ("b", 4, 2), ("m", 5, 2)
    ]


def pairs(spark, df, q):
    rows = metrics.staffing_vs_readmissions(df, q).collect()
    return {r.CCN: r for r in rows}


def test_readmission_matching(spark):
    day = datetime.timedelta(1)
    df = panel(
        spark,
        facility("tie", day=OCT - 10 * day, hours=1.0), facility("tie", day=OCT + 10 * day, hours=2.0),
        facility("near", day=OCT - 5 * day, hours=1.5), facility("near", day=OCT + 9 * day, hours=9.0),
        facility("gap", day=OCT, hours=None), facility("gap", day=D(2023, 1, 1), hours=7.0),
        facility("noend", day=OCT, hours=1.0), facility("noend", day=D(2023, 1, 1), hours=2.0),
        facility("dup", day=OCT, hours=6.0), facility("dup", day=OCT, hours=5.0),
        facility("only"),
    )
    q = measures(
        spark, *(score(c, "10.5") for c in ("tie", "near", "gap", "dup", "missing")),
        score("noend", "3", end=None),
        score("near", "Not Available", end=OCT + 30 * day), score("near", "8", end=OCT - 90 * day),
        score("tie", "99", code="OTHER"),
    )
    got = pairs(spark, df, q)
    assert set(got) == {"tie", "near", "gap", "noend", "dup"}
    assert got["tie"][STAFFING] == 2.0
    assert (got["near"][STAFFING], got["near"][metrics.READMISSION]) == (1.5, 10.5)
    assert got["gap"][STAFFING] == 7.0
    assert got["noend"].PROVIDER_SNAPSHOT_DATE == OCT
    assert got["dup"][STAFFING] == 5.0


def test_correlations(spark):
    df = panel(
        spark, *(facility(f"a{i}", "AL", hours=float(i)) for i in range(4)), facility("t", "TX"),
        facility("f1", "FL", hours=2.0), facility("f2", "FL", hours=2.0),
        facility("n1", None, hours=1.0), facility("n2", None, hours=2.0),
    )
    names = ["a0", "a1", "a2", "a3", "t", "f1", "f2", "n1", "n2"]
    q = measures(spark, *(score(c, str(10 - i)) for i, c in enumerate(names)))
    got = pairs(spark, df, q)
    assert got["a0"][metrics.STATE_CORR] == pytest.approx(-1.0)
    assert (got["t"][metrics.STATE_CORR], got["t"].STATE_OBSERVATION_COUNT) == (None, 1)
    assert (got["f1"][metrics.STATE_CORR], got["f1"].STATE_OBSERVATION_COUNT) == (None, 2)
    assert (got["n1"][metrics.STATE_CORR], got["n1"].STATE_OBSERVATION_COUNT) == (None, None)
    assert {r.NATIONAL_OBSERVATION_COUNT for r in got.values()} == {9}
    x = [0.0, 1.0, 2.0, 3.0, 3.0, 2.0, 2.0, 1.0, 2.0]
    y = [10.0 - i for i in range(9)]
    mx, my = sum(x) / 9, sum(y) / 9
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    expected = cov / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5
    assert got["t"][metrics.NATIONAL_CORR] == pytest.approx(expected)


def test_turnover_averages_include_null_state(spark):
    df = panel(
        spark, facility("1", total=10.0), facility("2", total=30.0), facility("3", total=None),
        facility("4", None, total=8.0), facility("5", None, total=4.0),
    )
    got = {r.CCN: r for r in metrics.nurse_turnover(lookback(df, OCT)).collect()}
    name = f"STATE_AVG_{TOTAL_TURNOVER}"
    assert [got[c][name] for c in "12345"] == [20.0, 20.0, 20.0, 6.0, 6.0]


def test_gold_schemas_and_roundtrip(spark, tmp_path):
    df = panel(spark, facility("1"), facility("2", "TX", hours=4.0), facility("3", None, hours=5.0))
    q = measures(spark, score("1", "9"), score("2", "7"), score("3", "5"))
    base = str(tmp_path)
    paths = metrics.build_gold(df, q, base)
    assert len(paths) == 5
    for name, schema in GOLD.items():
        back = read_gold(spark, base, name)
        assert back.columns == schema.names
        assert [f.dataType for f in back.schema] == [f.dataType for f in schema]
    loaded = load_dashboard(spark, base)
    assert {n: d.columns for n, d in loaded.items()} == {
        n: s.names for n, s in DASHBOARD_SCHEMAS.items()
    }
    ranks = [r.NATIONAL_RANK for r in read_gold(spark, base, "03_low_staffing_vs_patient_load").collect()]
    assert ranks == [1, 2, 3]


@pytest.fixture(scope="module")
def gold(spark):
    df = panel(
        spark, facility("1", "AL", beds=100.0, residents=50.0, hours=2.0, total=100.0, rn=10.0),
        facility("2", "AL", beds=0.0, hours=4.0, total=99.0, rn=None),
        facility("3", "TX", beds=100.0, residents=90.0, hours=None, total=20.0, rn=100.0),
        facility("4", None, beds=10.0, residents=12.0, hours=6.0, total=None, rn=5.0),
        facility("5", "NV", beds=None, hours=None, total=None, rn=None),
    )
    recent = lookback(df, OCT)
    return {
        "staffing": metrics.staffing_vs_occupancy(recent),
        "ranking": metrics.low_staffing(df, OCT, slices=2),
        "turnover": metrics.nurse_turnover(recent),
        "two_months": metrics.nurse_turnover(
            lookback(df.unionByName(panel(spark, facility("1", day=D(2024, 9, 1), total=None))), OCT)
        ),
    }


def test_overview(gold):
    row = dashboard.overview(gold["staffing"], gold["ranking"], gold["turnover"]).first()
    assert row.AVG_OCCUPANCY == pytest.approx((50 + 90 + 120) / 3)
    assert row.AVG_STAFFING == 4.0 and row.LOWEST_STAFFING == 2.0
    assert row.AVG_TURNOVER_TEXT == "73.0" and row.LATEST_MONTH_TEXT == "October 2024"
    empty = dashboard.overview(gold["staffing"], gold["ranking"], gold["turnover"], "ZZ").first()
    assert empty.AVG_OCCUPANCY is None and empty.AVG_OCCUPANCY_TEXT == "N/A"
    paired = dashboard.paired_averages(dashboard.staffing_scatter(gold["staffing"])).first()
    assert paired.AVG_OCCUPANCY == pytest.approx((50 + 120) / 2)


def test_heatmap(gold):
    rows = {r.STATE: r for r in dashboard.state_heatmap(gold["staffing"]).collect()}
    assert set(rows) == {"AL", "TX"}
    assert rows["AL"].OCCUPANCY_RATE_PCT_Z == pytest.approx(-1.0)
    assert (rows["AL"].STAFFING_HOURS_Z, rows["TX"].STAFFING_HOURS_Z) == (0.0, 0.0)
    assert rows["TX"].STAFFING_HOURS is None


def test_lowest_staffing(gold):
    top = dashboard.lowest_staffing(gold["ranking"], 2).collect()
    assert [(r.RANK, r.FACILITY) for r in top] == [(2, "Home 2"), (1, "Home 1")]
    assert dashboard.lowest_staffing(gold["ranking"], by_state=True).count() == 0
    state = dashboard.lowest_staffing(gold["ranking"], state="AL", by_state=True).collect()
    assert [r.RANK for r in state] == [2, 1]


def test_turnover_views(spark, gold):
    summary = dashboard.turnover_summary(gold["turnover"]).first()
    assert (summary.MONTHS, summary.MODE) == (1, "snapshot")
    assert dashboard.turnover_summary(gold["two_months"]).first().MODE == "trend"
    trend = dashboard.turnover_trend(gold["two_months"]).collect()
    assert len(trend) == 4
    assert [r.TURNOVER for r in trend if r.MONTH == D(2024, 9, 1)] == [40.0, None]
    states = dashboard.turnover_by_state(gold["turnover"]).collect()
    assert {(r.STATE, r.TURNOVER_TYPE) for r in states} == {
        (s, t) for s in ("AL", "TX") for t in ("Total Nursing Staff", "Registered Nurses")
    }
    one = dashboard.turnover_by_state(gold["turnover"], 1).collect()
    assert {r.STATE for r in one} == {"AL"}
    bins = {
        (r.TURNOVER_TYPE, r.BIN): r.ROWS
        for r in dashboard.turnover_distribution(gold["turnover"], "AL").collect()
    }
    assert bins == {("Total Nursing Staff", 20): 2, ("Registered Nurses", 3): 1}
    detail = {r.MEASURE: r[1] for r in dashboard.turnover_detail(gold["turnover"], "1").collect()}
    assert detail == {"Total Nursing Staff": 100.0, "Registered Nurses": 10.0}


def test_scatter_trend_and_lists(spark, gold):
    points = dashboard.staffing_scatter(gold["staffing"])
    line = dashboard.staffing_trend(points).orderBy("POINT").collect()
    assert len(line) == 100
    assert (line[0].X, line[0].Y) == pytest.approx((50.0, 2.0))
    assert (line[-1].X, line[-1].Y) == pytest.approx((120.0, 6.0))
    assert dashboard.staffing_trend(points.where("CCN = '1'")).count() == 0
    assert dashboard.staffing_trend(points.withColumn(OCCUPANCY, F.lit(1.0))).count() == 0
    assert [r[0] for r in dashboard.state_list(gold["staffing"]).collect()] == ["AL", "NV", "TX"]
    shown = [r.DISPLAY for r in dashboard.facility_list(gold["staffing"], "AL").collect()]
    assert shown == ["Home 1 (1)", "Home 2 (2)"]
    facilities = dashboard.facility_list(gold["staffing"])
    assert [r.CCN for r in dashboard.facility_of(facilities, "Home 4 (4)").collect()] == ["4"]


def test_scope_correlation(spark):
    df = panel(spark, *(facility(str(i), hours=float(i)) for i in range(3)))
    q = measures(spark, *(score(str(i), str(i)) for i in range(3)))
    table = metrics.staffing_vs_readmissions(df, q)
    national = dashboard.scope_correlation(table).first()
    assert national.TITLE.startswith("National") and national.CORRELATION_TEXT == "1.000"
    assert "very strong positive" in national.SENTENCE
    assert dashboard.scope_correlation(table, "AL").first().TITLE == "AL Pearson Correlation"
    one = dashboard.scope_correlation(table, ccn="1").first()
    assert one.CORRELATION is None and one.CORRELATION_TEXT == "N/A"
