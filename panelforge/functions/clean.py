"""Text, flag, number and date cleaning that never raises on dirty input.

Spark 4 runs with ANSI on, so a plain cast or ``to_date`` fails the job at the first
"Not Available". Everything here goes through the ``try_`` variants instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper-cased texts that mean "no value" in number and date columns.
NULL_TOKENS = ("", "NA", "N/A", "DATA NOT AVAILABLE")

# Accepted date layouts, first match wins.
DATE_FORMATS = ("MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd", "MM-dd-yyyy")

# The shape of a text decides which layout can fit it (``M/d/yyyy`` reads all that
# ``MM/dd/yyyy`` does), so each value is parsed once, and month 13 or day 45 not at all. A
# failed parse costs an exception inside Spark, which trying all layouts on every row would
# pay several times over.
_DAY, _MONTH = "(0[1-9]|[12][0-9]|3[01])", "(0[1-9]|1[0-2])"
_YEAR = r"(-?[0-9]{4}|[+-][0-9]{5,9})"
_SHAPES = (
    (f"^0*([1-9]|1[0-2])/0*([1-9]|[12][0-9]|3[01])/{_YEAR}$", DATE_FORMATS[1]),
    (f"^{_YEAR}-{_MONTH}-{_DAY}$", DATE_FORMATS[2]),
    (f"^{_MONTH}-{_DAY}-{_YEAR}$", DATE_FORMATS[3]),
)

# Characters removed from numbers before the cast.
NUMBER_DECORATION = ",$%"


def text(c: Column) -> Column:
    """Trimmed text, blank becomes NULL. "Data Not Available" is kept."""
    return F.nullif(F.trim(c), F.lit(""))


def yes_no(c: Column) -> Column:
    """Upper-cased flag text, blank becomes NULL."""
    return F.upper(text(c))


def is_null_token(c: Column) -> Column:
    return F.upper(F.trim(c)).isin(*NULL_TOKENS)


# Words ("Not Available") are not worth a cast: a failed one costs an exception inside
# Spark. A leading I may still be an infinity.
_WORD = r"^\s*[A-HJ-Za-hj-z]"


def to_double(c: Column) -> Column:
    """Text to double; unparseable text and NaN become NULL.

    NaN is mapped to NULL so that one "NaN" cell cannot poison an average.
    """
    value = F.when(~c.rlike(_WORD), c.try_cast("double"))
    return F.when(~F.isnan(value), value)


def number(c: Column) -> Column:
    raw = c.cast("string")
    stripped = F.translate(F.trim(raw), NUMBER_DECORATION, "")
    return F.when(~is_null_token(raw), to_double(stripped))


def date(c: Column) -> Column:
    """Text to date; null tokens, unknown layouts and impossible dates become NULL."""
    value = F.trim(c.cast("string"))
    parsed = F.lit(None).cast("date")
    for shape, layout in _SHAPES:
        parsed = F.when(value.rlike(shape), F.try_to_date(value, layout)).otherwise(parsed)
    return parsed


CLEANERS = {"text": text, "yes_no": yes_no, "number": number, "date": date}
