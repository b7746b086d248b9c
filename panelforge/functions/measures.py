"""Scalar business expressions and display text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` where ``whole`` is positive, else NULL. May exceed 100."""
    return F.when(whole > 0, part / whole * 100.0)


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def day_distance(a: Column, b: Column) -> Column:
    return F.abs(F.datediff(a, b))


def facility_label(name: Column, ccn: Column) -> Column:
    return F.concat(
        F.coalesce(name, F.lit("Unknown facility")),
        F.lit(" ("),
        F.coalesce(ccn, F.lit("Unknown CCN")),
        F.lit(")"),
    )


def number_text(value: Column, decimals: int = 2, suffix: str = "") -> Column:
    """Grouped fixed-decimal text, ``N/A`` for NULL."""
    return F.coalesce(F.concat(F.format_number(value, decimals), F.lit(suffix)), F.lit("N/A"))


def month_text(d: Column) -> Column:
    return F.coalesce(F.date_format(d, "MMMM yyyy"), F.lit("Unknown"))


# Upper bounds (exclusive) of the strength classes, and the sentences shown.
STRENGTH_BOUNDS = ((0.20, "very weak"), (0.40, "weak"), (0.60, "moderate"), (0.80, "strong"))
STRENGTH_TOP = "very strong"
NO_CORRELATION = "Not enough data to calculate a correlation."
ONE_FACILITY = (
    "A Pearson correlation cannot be calculated for one facility. Select All Facilities to "
    "view the national or selected-state correlation."
)
ZERO_CORRELATION = "There is essentially no linear relationship in this population."
STRENGTH_SENTENCE = (
    "This is a %s %s linear relationship. Correlation does not establish causation."
)


def strength_text(r: Column) -> Column:
    """One sentence describing a Pearson correlation."""
    size = F.lit(STRENGTH_TOP)
    for bound, word in reversed(STRENGTH_BOUNDS):
        size = F.when(F.abs(r) < bound, F.lit(word)).otherwise(size)
    direction = F.when(r > 0, F.lit("positive")).otherwise(F.lit("negative"))
    return (
        F.when(r.isNull() | F.isnan(r), F.lit(NO_CORRELATION))
        .when(r == 0, F.lit(ZERO_CORRELATION))
        .otherwise(F.format_string(STRENGTH_SENTENCE, size, direction))
    )
