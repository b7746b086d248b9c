"""Dashboard questions over the metric tables. Charts get only the rows they draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.functions.measures import (
    ONE_FACILITY,
    facility_label,
    month_text,
    number_text,
    strength_text,
)
from panelforge.operators.contracts import (
    BEDS,
    OCCUPANCY,
    RESIDENTS,
    RN_TURNOVER,
    STAFFING,
    TOTAL_TURNOVER,
)
from panelforge.operators.joins import attach_constant
from panelforge.operators.reshape import melt, recode
from panelforge.operators.scope import in_scope, scope_condition
from panelforge.operators.stats import group_means, histogram, trend_line, z_scores
from panelforge.operators.topk import top_n
from panelforge.plans.metrics import NATIONAL_CORR, READMISSION, STATE_CORR

TURNOVER = [TOTAL_TURNOVER, RN_TURNOVER]

# Measure names as shown, list lengths offered, states charted.
TURNOVER_LABELS = {TOTAL_TURNOVER: "Total Nursing Staff", RN_TURNOVER: "Registered Nurses"}
RANK_SIZES = (10, 25, 50)
TOP_STATES = 15


def overview(
    staffing: DataFrame, ranking: DataFrame, turnover: DataFrame,
    state: str | None = None, ccn: str | None = None,
) -> DataFrame:
    """The headline numbers of a scope, with their display text, in one row.

    Each table is read once. AVG_ numbers use every known value; PAIRED_ numbers only rows
    with both occupancy and staffing, so the two may differ. The latest month ignores the
    scope, hence the scope is a condition inside the first aggregate and not a filter.
    """
    paired = F.col(OCCUPANCY).isNotNull() & F.col(STAFFING).isNotNull()

    def mean(c: str, condition: Column) -> Column:
        return F.avg(F.when(condition, F.col(c)))

    inside = scope_condition(state, ccn)
    first = staffing.agg(
        mean(OCCUPANCY, inside).alias("AVG_OCCUPANCY"),
        mean(STAFFING, inside).alias("AVG_STAFFING"),
        mean(OCCUPANCY, inside & paired).alias("PAIRED_OCCUPANCY"),
        mean(STAFFING, inside & paired).alias("PAIRED_STAFFING"),
        F.max("MONTH").alias("LATEST_MONTH"),
    )
    second = in_scope(ranking, state, ccn).agg(F.min(STAFFING).alias("LOWEST_STAFFING"))
    row = attach_constant(first, second)
    row = attach_constant(row, turnover_summary(turnover, state, ccn))
    return row.withColumns(
        {
            "AVG_OCCUPANCY_TEXT": number_text(F.col("AVG_OCCUPANCY"), 1, "%"),
            "AVG_STAFFING_TEXT": number_text(F.col("AVG_STAFFING"), 2),
            "LOWEST_STAFFING_TEXT": number_text(F.col("LOWEST_STAFFING"), 2),
            "AVG_TURNOVER_TEXT": number_text(F.col("AVG_TURNOVER"), 1),
            "AVG_RN_TURNOVER_TEXT": number_text(F.col("AVG_RN_TURNOVER"), 1),
            "LATEST_MONTH_TEXT": month_text(F.col("LATEST_MONTH")),
        }
    )


def turnover_summary(
    turnover: DataFrame, state: str | None = None, ccn: str | None = None
) -> DataFrame:
    """Averages and months of a scope; two or more months mean a trend can be drawn."""
    row = in_scope(turnover, state, ccn).agg(
        F.avg(TOTAL_TURNOVER).alias("AVG_TURNOVER"),
        F.avg(RN_TURNOVER).alias("AVG_RN_TURNOVER"),
        F.count_distinct("MONTH").alias("MONTHS"),
        F.max("MONTH").alias("LATEST_TURNOVER_MONTH"),
    )
    mode = F.when(F.col("MONTHS") >= 2, F.lit("trend")).otherwise(F.lit("snapshot"))
    return row.withColumn("MODE", mode)


# Scopes of the cube: everything, one state, one facility of a state.
SCOPES = ("all", "state", "facility")


def _scope_name() -> Column:
    level = F.grouping_id()
    return F.when(level == 3, F.lit(SCOPES[0])).when(level == 1, F.lit(SCOPES[1])).otherwise(F.lit(SCOPES[2]))


def scope_cube(staffing: DataFrame, ranking: DataFrame, turnover: DataFrame) -> DataFrame:
    """The headline numbers of every scope at once: of all facilities, each state, and each facility.

    One row a scope: SCOPE, STATE and CCN, and the numbers of ``overview``. The three tables are brought to one long
    form and aggregated once by GROUPING SETS over (), (STATE) and (STATE, CCN). Partial sums are taken before the
    exchange, so a state with a third of all rows sends one row a task. Rows without a state belong to no state
    scope; the latest month is that of all.
    """
    paired = F.col(OCCUPANCY).isNotNull() & F.col(STAFFING).isNotNull()
    number, day = F.lit(None).cast("double"), F.lit(None).cast("date")

    def shaped(df: DataFrame, **columns: Column) -> DataFrame:
        empty = {"OCC": number, "HOURS": number, "PAIRED_OCC": number, "PAIRED_HOURS": number, "LOW": number,
                 "TOTAL": number, "RN": number, "MONTH_SEEN": day, "TURNOVER_MONTH": day}
        return df.select("STATE", "CCN", *(c.alias(n) for n, c in {**empty, **columns}.items()))

    rows = (
        shaped(
            staffing, OCC=F.col(OCCUPANCY), HOURS=F.col(STAFFING), PAIRED_OCC=F.when(paired, F.col(OCCUPANCY)),
            PAIRED_HOURS=F.when(paired, F.col(STAFFING)), MONTH_SEEN=F.col("MONTH"),
        )
        .unionByName(shaped(ranking, LOW=F.col(STAFFING)))
        .unionByName(shaped(turnover, TOTAL=F.col(TOTAL_TURNOVER), RN=F.col(RN_TURNOVER), TURNOVER_MONTH=F.col("MONTH")))
    )
    state, ccn = F.col("STATE"), F.col("CCN")
    # A scope has as many different months as the calendar, so this set is small.
    months = F.size(F.collect_set("TURNOVER_MONTH"))
    cube = rows.groupingSets([[], [state], [state, ccn]], state, ccn).agg(
        _scope_name().alias("SCOPE"),
        F.avg("OCC").alias("AVG_OCCUPANCY"),
        F.avg("HOURS").alias("AVG_STAFFING"),
        F.avg("PAIRED_OCC").alias("PAIRED_OCCUPANCY"),
        F.avg("PAIRED_HOURS").alias("PAIRED_STAFFING"),
        F.min("LOW").alias("LOWEST_STAFFING"),
        F.avg("TOTAL").alias("AVG_TURNOVER"),
        F.avg("RN").alias("AVG_RN_TURNOVER"),
        months.cast("long").alias("MONTHS"),
        F.max("MONTH_SEEN").alias("LATEST_MONTH"),
    )
    mode = F.when(F.col("MONTHS") >= 2, F.lit("trend")).otherwise(F.lit("snapshot"))
    return cube.where((F.col("SCOPE") == SCOPES[0]) | F.col("STATE").isNotNull()).withColumn("MODE", mode)


def state_heatmap(staffing: DataFrame, state: str | None = None, ccn: str | None = None) -> DataFrame:
    """State means of occupancy and staffing with z-scores over the states shown."""
    means = group_means(
        in_scope(staffing, state, ccn), "STATE", {OCCUPANCY: OCCUPANCY, "STAFFING_HOURS": STAFFING}
    )
    columns = [OCCUPANCY, "STAFFING_HOURS"]
    return z_scores(means.na.drop("all", subset=columns), columns).orderBy("STATE")


def staffing_scatter(
    staffing: DataFrame, state: str | None = None, ccn: str | None = None
) -> DataFrame:
    columns = ["CCN", "PROVIDER_NAME", "STATE", OCCUPANCY, STAFFING, RESIDENTS, BEDS]
    return in_scope(staffing, state, ccn).select(*columns).na.drop(subset=[OCCUPANCY, STAFFING])


def paired_averages(points: DataFrame) -> DataFrame:
    """Averages over the points of ``staffing_scatter``."""
    return points.agg(
        F.avg(OCCUPANCY).alias("AVG_OCCUPANCY"), F.avg(STAFFING).alias("AVG_STAFFING")
    )


def staffing_trend(points: DataFrame) -> DataFrame:
    return trend_line(points, OCCUPANCY, STAFFING)


def lowest_staffing(
    ranking: DataFrame, n: int = RANK_SIZES[0], state: str | None = None,
    ccn: str | None = None, by_state: bool = False,
) -> DataFrame:
    """The ``n`` lowest-staffed facilities, highest staffing first as charted.

    A state ranking without a chosen state is empty.
    """
    rank = "STATE_RANK" if by_state else "NATIONAL_RANK"
    source = in_scope(ranking, state, ccn)
    if by_state and state is None:
        source = source.limit(0)
    lowest = top_n(source.na.drop(subset=[STAFFING, rank]), n, F.col(rank), F.col("CCN"))
    return lowest.orderBy(F.col(STAFFING).desc(), F.col(rank)).select(
        F.col(rank).alias("RANK"),
        F.col("PROVIDER_NAME").alias("FACILITY"),
        "STATE",
        F.col(RESIDENTS).alias("AVG_RESIDENTS_PER_DAY"),
        F.col(STAFFING).alias("STAFFING_HOURS_PER_RESIDENT_DAY"),
    )


def readmission_scatter(
    readmissions: DataFrame, state: str | None = None, ccn: str | None = None
) -> DataFrame:
    columns = ["CCN", "PROVIDER_NAME", "STATE", STAFFING, READMISSION, STATE_CORR, NATIONAL_CORR]
    return (
        in_scope(readmissions, state, ccn).select(*columns).na.drop(subset=[STAFFING, READMISSION])
    )


def readmission_trend(points: DataFrame) -> DataFrame:
    return trend_line(points, STAFFING, READMISSION)


def scope_correlation(
    readmissions: DataFrame, state: str | None = None, ccn: str | None = None
) -> DataFrame:
    """The correlation that fits the scope, with title, number text and sentence.

    The stored value is the same on every row of a scope, so its maximum is that value. A
    single facility has none.
    """
    points = readmission_scatter(readmissions, state, ccn)
    if ccn is not None:
        title, value = "Correlation", F.max(F.lit(None).cast("double"))
    elif state is not None:
        title, value = f"{state} Pearson Correlation", F.max(STATE_CORR)
    else:
        title, value = "National Pearson Correlation", F.max(NATIONAL_CORR)
    row = points.agg(value.alias("CORRELATION"))
    return row.select(
        F.lit(title).alias("TITLE"),
        "CORRELATION",
        number_text(F.col("CORRELATION"), 3).alias("CORRELATION_TEXT"),
        (F.lit(ONE_FACILITY) if ccn is not None else strength_text(F.col("CORRELATION"))).alias(
            "SENTENCE"
        ),
    )


def turnover_trend(
    turnover: DataFrame, state: str | None = None, ccn: str | None = None
) -> DataFrame:
    """Monthly means in long form; NULL means stay."""
    monthly = group_means(in_scope(turnover, state, ccn), "MONTH", {m: m for m in TURNOVER})
    return melt(monthly, ["MONTH"], TURNOVER, value="TURNOVER").orderBy("MONTH", "TURNOVER_TYPE")


def _labelled(long: DataFrame) -> DataFrame:
    return long.withColumn("TURNOVER_TYPE", recode(F.col("TURNOVER_TYPE"), TURNOVER_LABELS))


def turnover_by_state(turnover: DataFrame, n: int = TOP_STATES) -> DataFrame:
    """The states with the highest mean turnover, both measures, labelled; ties by state."""
    means = group_means(turnover, "STATE", {m: m for m in TURNOVER})
    known = means.na.drop(subset=[TOTAL_TURNOVER])
    return _labelled(melt(top_n(known, n, F.col(TOTAL_TURNOVER).desc(), F.col("STATE")), ["STATE"], TURNOVER))


def turnover_distribution(turnover: DataFrame, state: str) -> DataFrame:
    """Facilities per five-point turnover bin in one state, per measure."""
    long = melt(in_scope(turnover, state).select(*TURNOVER), [], TURNOVER, keep_nulls=False)
    return histogram(_labelled(long), "TURNOVER_RATE_PCT", ["TURNOVER_TYPE"])


def turnover_detail(turnover: DataFrame, ccn: str) -> DataFrame:
    """Both measures of one facility as two rows (the first of its rows in column order)."""
    columns = ["CCN", "MONTH", "PROVIDER_NAME", *TURNOVER]
    one = top_n(in_scope(turnover, ccn=ccn).select(*columns), 1, *map(F.col, columns))
    return _labelled(melt(one.select(*TURNOVER), [], TURNOVER)).select(
        F.col("TURNOVER_TYPE").alias("MEASURE"),
        F.col("TURNOVER_RATE_PCT").alias("ANNUAL_TURNOVER_RATE_PCT"),
    )


def state_list(staffing: DataFrame) -> DataFrame:
    return staffing.select("STATE").na.drop().distinct().orderBy("STATE")


def facility_list(staffing: DataFrame, state: str | None = None) -> DataFrame:
    columns = ["CCN", "PROVIDER_NAME", "STATE"]
    return (
        in_scope(staffing.select(*columns), state)
        .distinct()
        .withColumn("DISPLAY", facility_label(F.col("PROVIDER_NAME"), F.col("CCN")))
        .orderBy(F.col("PROVIDER_NAME").asc_nulls_last(), F.col("CCN").asc_nulls_last())
    )


def facility_of(facilities: DataFrame, display: str) -> DataFrame:
    """The CCN behind a chosen label of ``facility_list``, the first if several share it."""
    chosen = facilities.where(F.col("DISPLAY") == display)
    return top_n(chosen, 1, F.col("PROVIDER_NAME"), F.col("CCN")).select("CCN")
