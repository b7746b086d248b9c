"""Column contracts at the layer boundaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.clean import to_double
from panelforge.functions.dictionaries import RESERVED
from panelforge.functions.names import normalize_header
from panelforge.schemas import columns

STAFFING_SOURCE = "REPORTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY"
STAFFING = "TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_DAY"
RESIDENTS = "AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY"
BEDS = "NUMBER_OF_CERTIFIED_BEDS"
OCCUPANCY = "OCCUPANCY_RATE_PCT"
TOTAL_TURNOVER = "TOTAL_NURSING_STAFF_TURNOVER"
RN_TURNOVER = "REGISTERED_NURSE_TURNOVER"


# Silver columns the metrics read, with the types they need.
FACILITY_PANEL = columns(
    f"CCN string, PROVIDER_NAME string, STATE string, SNAPSHOT_DATE date, {BEDS} double, "
    f"{RESIDENTS} double, {STAFFING_SOURCE} double, {TOTAL_TURNOVER} double, "
    f"{RN_TURNOVER} double"
)
MEASURE_TABLE = columns(
    "CCN string, MEASURE_CODE string, SCORE string, START_DATE date, END_DATE date, "
    "SNAPSHOT_DATE date"
)

# Metric tables, columns in order.
_PANEL_KEYS = "CCN string, PROVIDER_NAME string, STATE string, MONTH date"
GOLD = {
    "01_occupancy_trends": columns(
        f"{_PANEL_KEYS}, {BEDS} double, {RESIDENTS} double, {OCCUPANCY} double"
    ),
    "02_staffing_vs_occupancy": columns(
        f"{_PANEL_KEYS}, {BEDS} double, {RESIDENTS} double, {OCCUPANCY} double, {STAFFING} double"
    ),
    "03_low_staffing_vs_patient_load": columns(
        f"{_PANEL_KEYS}, {RESIDENTS} double, {STAFFING} double, NATIONAL_RANK int, STATE_RANK int"
    ),
    "04_staffing_vs_readmissions": columns(
        "STATE string, CCN string, PROVIDER_NAME string, PROVIDER_SNAPSHOT_DATE date, "
        "QRP_START_DATE date, QRP_END_DATE date, QRP_SNAPSHOT_DATE date, "
        f"{STAFFING} double, READMISSION_RATE_RSRR double, "
        "STATE_STAFFING_READMISSION_CORRELATION double, STATE_OBSERVATION_COUNT long, "
        "NATIONAL_STAFFING_READMISSION_CORRELATION double, NATIONAL_OBSERVATION_COUNT long"
    ),
    "05_nurse_turnover_trends": columns(
        f"{_PANEL_KEYS}, {TOTAL_TURNOVER} double, {RN_TURNOVER} double, "
        f"STATE_AVG_{TOTAL_TURNOVER} double, STATE_AVG_{RN_TURNOVER} double"
    ),
}

# Row order of each metric table as written.
GOLD_ORDER = {
    "01_occupancy_trends": ("STATE", "PROVIDER_NAME", "MONTH"),
    "02_staffing_vs_occupancy": ("MONTH", "STATE", "PROVIDER_NAME"),
    "03_low_staffing_vs_patient_load": ("NATIONAL_RANK",),
    "04_staffing_vs_readmissions": ("STATE", "PROVIDER_NAME"),
    "05_nurse_turnover_trends": ("STATE", "PROVIDER_NAME", "MONTH"),
}

# The metric tables the dashboard reads (the first one is left out) and the
# columns it does not ask for.
DASHBOARD_TABLES = {
    "staffing_vs_occupancy": "02_staffing_vs_occupancy",
    "low_staffing": "03_low_staffing_vs_patient_load",
    "staffing_vs_readmissions": "04_staffing_vs_readmissions",
    "nurse_turnover": "05_nurse_turnover_trends",
}
DASHBOARD_UNUSED = ("QRP_SNAPSHOT_DATE", "STATE_OBSERVATION_COUNT", "NATIONAL_OBSERVATION_COUNT")
DASHBOARD_SCHEMAS = {
    name: T.StructType([f for f in GOLD[table].fields if f.name not in DASHBOARD_UNUSED])
    for name, table in DASHBOARD_TABLES.items()
}


def missing_columns(have: Iterable[str], expected: Iterable[str]) -> list[str]:
    return sorted(set(expected) - set(have))


def require_columns(df: DataFrame, expected: Iterable[str], dataset: str) -> DataFrame:
    missing = missing_columns(df.columns, expected)
    if missing:
        raise ValueError(f"{dataset} lacks required columns {missing}; found {df.columns}")
    return df


def normalized_names(headers: list[str], source: str) -> list[str]:
    """Normalised header names; two headers with one normal form are an error."""
    names = [normalize_header(h) for h in headers]
    if len(set(names)) < len(names):
        twice = sorted({n for n in names if names.count(n) > 1})
        raise ValueError(f"{source}: several headers normalise to {twice}; headers {headers}")
    return names


def reject_reserved(names: Iterable[str], source: str) -> None:
    clash = sorted(set(names) & set(RESERVED))
    if clash:
        raise ValueError(f"{source}: reserved metadata columns present in the source: {clash}")


def normalize_columns(df: DataFrame, source: str = "source") -> DataFrame:
    return df.toDF(*normalized_names(df.columns, source))


def _conformed(field: T.StructField, have: T.DataType):
    c = F.col(f"`{field.name}`")
    if have == field.dataType:
        return c
    if isinstance(field.dataType, T.DoubleType):
        return to_double(c) if isinstance(have, T.StringType) else c.cast("double")
    if isinstance(field.dataType, T.DateType):
        return F.try_to_date(c) if isinstance(have, T.StringType) else c.cast("date")
    return c.try_cast(field.dataType)


def conform(df: DataFrame, schema: T.StructType, dataset: str) -> DataFrame:
    """Select the contract columns in the contract types.

    A column that already has its type is passed through bare, so filters on it still
    reach the Parquet scan; the others are cast with NULL on failure.
    """
    require_columns(df, schema.names, dataset)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*(_conformed(f, types[f.name]).alias(f.name) for f in schema.fields))
