"""The five metric tables."""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.clean import to_double
from panelforge.functions.measures import percent_of
from panelforge.operators.contracts import (
    BEDS,
    FACILITY_PANEL,
    MEASURE_TABLE,
    OCCUPANCY,
    RESIDENTS,
    RN_TURNOVER,
    STAFFING,
    STAFFING_SOURCE,
    TOTAL_TURNOVER,
    conform,
)
from panelforge.operators.joins import attach, attach_constant
from panelforge.operators.nearest import nearest_join
from panelforge.operators.panel import (
    DEFAULT_LOOKBACK_MONTHS,
    at_snapshot,
    latest_snapshot,
    lookback,
)
from panelforge.operators.rank import rank_rows
from panelforge.operators.stats import correlate
from panelforge.operators.topk import first_per_key
from panelforge.runtime import freeze, scratch_scope
from panelforge.sources.gold import write_gold

# Fixed value: the measure compared with staffing.
READMISSION_MEASURE = "S_004_01_PPR_PD_RSRR"
READMISSION = "READMISSION_RATE_RSRR"
STATE_CORR = "STATE_STAFFING_READMISSION_CORRELATION"
NATIONAL_CORR = "NATIONAL_STAFFING_READMISSION_CORRELATION"


def facility_panel(silver: DataFrame) -> DataFrame:
    return conform(silver, FACILITY_PANEL, "facility silver")


def measure_table(silver: DataFrame) -> DataFrame:
    return conform(silver, MEASURE_TABLE, "measure silver")


def _occupancy() -> Column:
    return percent_of(F.col(RESIDENTS), F.col(BEDS)).alias(OCCUPANCY)


def occupancy_trends(recent: DataFrame) -> DataFrame:
    """Occupancy per facility and month; ``recent`` comes from ``lookback``."""
    return recent.select("CCN", "PROVIDER_NAME", "STATE", "MONTH", BEDS, RESIDENTS, _occupancy())


def staffing_vs_occupancy(recent: DataFrame) -> DataFrame:
    return recent.select(
        "CCN", "PROVIDER_NAME", "STATE", "MONTH", BEDS, RESIDENTS, _occupancy(),
        F.col(STAFFING_SOURCE).alias(STAFFING),
    )


def staffed_facilities(panel: DataFrame, latest: datetime.date) -> DataFrame:
    """Facilities of the latest snapshot that report staffing."""
    return at_snapshot(panel, latest).where(F.col(STAFFING_SOURCE).isNotNull()).select(
        "CCN", "PROVIDER_NAME", "STATE", F.col("SNAPSHOT_DATE").alias("MONTH"), RESIDENTS,
        F.col(STAFFING_SOURCE).alias(STAFFING),
    )


def low_staffing(panel: DataFrame, latest: datetime.date, slices: int | None = None) -> DataFrame:
    """Every facility of the latest snapshot ranked by staffing, nationally and by state."""
    ranked = rank_rows(
        staffed_facilities(panel, latest),
        order=[F.col(STAFFING).asc_nulls_last(), F.col("CCN").asc()],
        order_columns=[STAFFING, "CCN"],
        rank_column="NATIONAL_RANK",
        group=["STATE"],
        group_rank_column="STATE_RANK",
        slices=slices,
    )
    ranks = ("NATIONAL_RANK", "STATE_RANK")
    return ranked.withColumns({r: F.col(r).cast("int") for r in ranks})


def latest_scores(measures: DataFrame, code: str = READMISSION_MEASURE) -> DataFrame:
    """The newest numeric score of each facility for one measure.

    Scores that are not numbers are dropped first, so an older number wins over a newer
    "Not Available".
    """
    scored = (
        measures.where(F.col("MEASURE_CODE") == code)
        .select(
            "CCN",
            F.col("START_DATE").alias("QRP_START_DATE"),
            F.col("END_DATE").alias("QRP_END_DATE"),
            F.col("SNAPSHOT_DATE").alias("QRP_SNAPSHOT_DATE"),
            to_double(F.col("SCORE")).alias(READMISSION),
        )
        .where(F.col(READMISSION).isNotNull())
    )
    newest = [F.col(c).desc_nulls_last() for c in ("QRP_END_DATE", "QRP_SNAPSHOT_DATE")]
    return first_per_key(scored, ["CCN"], newest)


def readmission_pairs(panel: DataFrame, measures: DataFrame) -> DataFrame:
    """Per facility: the newest score and the staffing snapshot nearest to its end date."""
    staffed = panel.select(
        "CCN", "PROVIDER_NAME", "STATE", F.col("SNAPSHOT_DATE").alias("PROVIDER_SNAPSHOT_DATE"),
        F.col(STAFFING_SOURCE).alias(STAFFING),
    ).where(F.col(STAFFING).isNotNull())
    pairs = nearest_join(
        staffed, latest_scores(measures), ["CCN"], "PROVIDER_SNAPSHOT_DATE", "QRP_END_DATE"
    )
    return pairs.select(
        "CCN", "PROVIDER_NAME", "STATE", "PROVIDER_SNAPSHOT_DATE", "QRP_START_DATE",
        "QRP_END_DATE", "QRP_SNAPSHOT_DATE", STAFFING, READMISSION,
    )


def with_correlations(pairs: DataFrame) -> DataFrame:
    """Repeat the state and national correlation and counts on every facility row.

    The state join does not match NULL, so facilities without a state get no state value.
    """
    by_state = correlate(
        pairs, ["STATE"], STAFFING, READMISSION, STATE_CORR, "STATE_OBSERVATION_COUNT"
    )
    overall = correlate(
        pairs, [], STAFFING, READMISSION, NATIONAL_CORR, "NATIONAL_OBSERVATION_COUNT"
    )
    rest = [c for c in pairs.columns if c != "STATE"]
    joined = attach_constant(attach(pairs, by_state, ["STATE"]), overall)
    return joined.select(
        "STATE", *rest, STATE_CORR, "STATE_OBSERVATION_COUNT", NATIONAL_CORR,
        "NATIONAL_OBSERVATION_COUNT",
    )


def staffing_vs_readmissions(panel: DataFrame, measures: DataFrame) -> DataFrame:
    """All history. The pairs are written once: three aggregates and joins read them."""
    return with_correlations(freeze(readmission_pairs(panel, measures)))


def nurse_turnover(recent: DataFrame) -> DataFrame:
    """Turnover per facility and month with the state-month averages on each row.

    Averages are combined on the map side and attached, so no state-month is gathered in
    one task. NULL states share one average.
    """
    keys = ["STATE", "MONTH"]
    rows = recent.select("CCN", "PROVIDER_NAME", *keys, TOTAL_TURNOVER, RN_TURNOVER)
    averages = rows.groupBy(*keys).agg(
        F.avg(TOTAL_TURNOVER).alias(f"STATE_AVG_{TOTAL_TURNOVER}"),
        F.avg(RN_TURNOVER).alias(f"STATE_AVG_{RN_TURNOVER}"),
    )
    return attach(rows, averages, keys, match_nulls=True)


def metric_tables(
    facility_silver: DataFrame,
    measure_silver: DataFrame,
    months: int = DEFAULT_LOOKBACK_MONTHS,
    latest: datetime.date | None = None,
    recent: DataFrame | None = None,
) -> dict[str, Callable[[], DataFrame]]:
    """The five tables by folder name, each built when it is called."""
    panel, measures = facility_panel(facility_silver), measure_table(measure_silver)
    latest = latest or latest_snapshot(panel)
    recent = lookback(panel, latest, months) if recent is None else recent
    return {
        "01_occupancy_trends": lambda: occupancy_trends(recent),
        "02_staffing_vs_occupancy": lambda: staffing_vs_occupancy(recent),
        "03_low_staffing_vs_patient_load": lambda: low_staffing(panel, latest),
        "04_staffing_vs_readmissions": lambda: staffing_vs_readmissions(panel, measures),
        "05_nurse_turnover_trends": lambda: nurse_turnover(recent),
    }


def build_gold(
    facility_silver: DataFrame,
    measure_silver: DataFrame,
    base: str,
    months: int = DEFAULT_LOOKBACK_MONTHS,
) -> list[str]:
    """Write all five tables under ``base``.

    Three of them, each with a range sort that samples first, read the lookback rows, so
    those nine columns are kept in memory (spilling to disk) while the job runs.
    """
    panel = facility_panel(facility_silver)
    latest = latest_snapshot(panel)
    recent = lookback(panel, latest, months).persist()
    try:
        with scratch_scope(facility_silver.sparkSession):
            tables = metric_tables(facility_silver, measure_silver, months, latest, recent)
            return [write_gold(build(), base, name) for name, build in tables.items()]
    finally:
        recent.unpersist()
