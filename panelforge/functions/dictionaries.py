"""Column dictionaries of the two snapshot families."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

# Names added by the silver build. A source file may not carry any of them.
SOURCE_FILE = "SOURCE_FILE_NAME"
SNAPSHOT_DATE = "SNAPSHOT_DATE"
PROCESSED_AT = "SILVER_PROCESSED_AT"
RESERVED = (SOURCE_FILE, SNAPSHOT_DATE, PROCESSED_AT)


@dataclass(frozen=True)
class SnapshotFamily:
    """What is known about one family of monthly files.

    ``kinds`` maps a normalised column name to ``text``, ``yes_no``, ``date`` or
    ``number``. Columns outside the map stay as the raw string.
    """

    label: str
    file_pattern: str
    kinds: Mapping[str, str]
    required: tuple[str, ...] = ()

    def with_kinds(self, **overrides: str) -> SnapshotFamily:
        """The same family with some columns typed differently, e.g. ``ZIP_CODE="text"``."""
        return replace(self, kinds={**self.kinds, **overrides})


def _kinds(**names: str) -> dict[str, str]:
    return {name: kind for kind, block in names.items() for name in block.split()}


# File-name pattern and column types of the facility snapshots.
FACILITY = SnapshotFamily(
    label="facility snapshots",
    file_pattern=r"(?i)^NH_ProviderInfo_[A-Za-z]+[0-9]{4}\.csv$",
    kinds=_kinds(
        text="""
            CCN PROVIDER_NAME PROVIDER_ADDRESS CITY_TOWN STATE COUNTY_PARISH OWNERSHIP_TYPE
            PROVIDER_TYPE LEGAL_BUSINESS_NAME AFFILIATED_ENTITY_NAME SPECIAL_FOCUS_STATUS
            WITH_A_RESIDENT_AND_FAMILY_COUNCIL
            AUTOMATIC_SPRINKLER_SYSTEMS_IN_ALL_REQUIRED_AREAS LOCATION
        """,
        yes_no="""
            PROVIDER_RESIDES_IN_HOSPITAL CONTINUING_CARE_RETIREMENT_COMMUNITY ABUSE_ICON
            MOST_RECENT_HEALTH_INSPECTION_MORE_THAN_2_YEARS_AGO
            PROVIDER_CHANGED_OWNERSHIP_IN_LAST_12_MONTHS
        """,
        date="""
            DATE_FIRST_APPROVED_TO_PROVIDE_MEDICARE_AND_MEDICAID_SERVICES
            RATING_CYCLE_1_STANDARD_SURVEY_HEALTH_DATE
            RATING_CYCLE_2_STANDARD_HEALTH_SURVEY_DATE
            RATING_CYCLE_3_STANDARD_HEALTH_SURVEY_DATE PROCESSING_DATE
        """,
        number="""
            ZIP_CODE TELEPHONE_NUMBER PROVIDER_SSA_COUNTY_CODE NUMBER_OF_CERTIFIED_BEDS
            AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY AVERAGE_NUMBER_OF_RESIDENTS_PER_DAY_FOOTNOTE
            AFFILIATED_ENTITY_ID
            OVERALL_RATING OVERALL_RATING_FOOTNOTE
            HEALTH_INSPECTION_RATING HEALTH_INSPECTION_RATING_FOOTNOTE
            QM_RATING QM_RATING_FOOTNOTE
            LONG_STAY_QM_RATING LONG_STAY_QM_RATING_FOOTNOTE
            SHORT_STAY_QM_RATING SHORT_STAY_QM_RATING_FOOTNOTE
            STAFFING_RATING STAFFING_RATING_FOOTNOTE
            REPORTED_STAFFING_FOOTNOTE PHYSICAL_THERAPIST_STAFFING_FOOTNOTE
            REPORTED_NURSE_AIDE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            REPORTED_LPN_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            REPORTED_RN_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            REPORTED_LICENSED_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            REPORTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            TOTAL_NUMBER_OF_NURSE_STAFF_HOURS_PER_RESIDENT_PER_DAY_ON_THE_WEEKEND
            REGISTERED_NURSE_HOURS_PER_RESIDENT_PER_DAY_ON_THE_WEEKEND
            REPORTED_PHYSICAL_THERAPIST_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            TOTAL_NURSING_STAFF_TURNOVER TOTAL_NURSING_STAFF_TURNOVER_FOOTNOTE
            REGISTERED_NURSE_TURNOVER REGISTERED_NURSE_TURNOVER_FOOTNOTE
            NUMBER_OF_ADMINISTRATORS_WHO_HAVE_LEFT_THE_NURSING_HOME
            ADMINISTRATOR_TURNOVER_FOOTNOTE
            NURSING_CASE_MIX_INDEX NURSING_CASE_MIX_INDEX_RATIO
            CASE_MIX_NURSE_AIDE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            CASE_MIX_LPN_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            CASE_MIX_RN_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            CASE_MIX_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            CASE_MIX_WEEKEND_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            ADJUSTED_NURSE_AIDE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            ADJUSTED_LPN_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            ADJUSTED_RN_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            ADJUSTED_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            ADJUSTED_WEEKEND_TOTAL_NURSE_STAFFING_HOURS_PER_RESIDENT_PER_DAY
            RATING_CYCLE_1_TOTAL_NUMBER_OF_HEALTH_DEFICIENCIES
            RATING_CYCLE_1_NUMBER_OF_STANDARD_HEALTH_DEFICIENCIES
            RATING_CYCLE_1_NUMBER_OF_COMPLAINT_HEALTH_DEFICIENCIES
            RATING_CYCLE_1_HEALTH_DEFICIENCY_SCORE
            RATING_CYCLE_1_NUMBER_OF_HEALTH_REVISITS
            RATING_CYCLE_1_HEALTH_REVISIT_SCORE
            RATING_CYCLE_1_TOTAL_HEALTH_SCORE
            RATING_CYCLE_2_TOTAL_NUMBER_OF_HEALTH_DEFICIENCIES
            RATING_CYCLE_2_NUMBER_OF_STANDARD_HEALTH_DEFICIENCIES
            RATING_CYCLE_2_NUMBER_OF_COMPLAINT_HEALTH_DEFICIENCIES
            RATING_CYCLE_2_HEALTH_DEFICIENCY_SCORE
            RATING_CYCLE_2_NUMBER_OF_HEALTH_REVISITS
            RATING_CYCLE_2_HEALTH_REVISIT_SCORE
            RATING_CYCLE_2_TOTAL_HEALTH_SCORE
            RATING_CYCLE_3_TOTAL_NUMBER_OF_HEALTH_DEFICIENCIES
            RATING_CYCLE_3_NUMBER_OF_STANDARD_HEALTH_DEFICIENCIES
            RATING_CYCLE_3_NUMBER_OF_COMPLAINT_HEALTH_DEFICIENCIES
            RATING_CYCLE_3_HEALTH_DEFICIENCY_SCORE
            RATING_CYCLE_3_NUMBER_OF_HEALTH_REVISITS
            RATING_CYCLE_3_HEALTH_REVISIT_SCORE
            RATING_CYCLE_3_TOTAL_HEALTH_SCORE
            TOTAL_WEIGHTED_HEALTH_SURVEY_SCORE
            NUMBER_OF_FACILITY_REPORTED_INCIDENTS NUMBER_OF_SUBSTANTIATED_COMPLAINTS
            NUMBER_OF_CITATIONS_FROM_INFECTION_CONTROL_INSPECTIONS
            NUMBER_OF_FINES TOTAL_AMOUNT_OF_FINES_IN_DOLLARS
            NUMBER_OF_PAYMENT_DENIALS TOTAL_NUMBER_OF_PENALTIES
            LATITUDE LONGITUDE GEOCODING_FOOTNOTE
        """,
    ),
)

# File-name pattern, column types and identity columns of the measure snapshots.
MEASURES = SnapshotFamily(
    label="quality-measure snapshots",
    file_pattern=(
        r"(?i)^Skilled_Nursing_Facility_Quality_Reporting_Program_Provider_Data_"
        r"[A-Za-z]+[0-9]{4}\.csv$"
    ),
    kinds=_kinds(
        text="""
            CCN PROVIDER_NAME ADDRESS_LINE_1 ADDRESS_LINE_2 CITY_TOWN STATE COUNTY_PARISH
            TELEPHONE_NUMBER MEASURE_CODE SCORE FOOTNOTE MEASURE_DATE_RANGE LOCATION1
        """,
        date="START_DATE END_DATE",
        number="ZIP_CODE CMS_REGION",
    ),
    required=("MEASURE_CODE", "SCORE", "START_DATE", "END_DATE"),
)
