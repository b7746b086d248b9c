"""Header names, snapshot months in file names, storage paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the one header that gets a shorter name.
HEADER_ALIASES = {"CMS_CERTIFICATION_NUMBER_CCN": "CCN"}


def normalize_header(name: str) -> str:
    """Display header to UPPER_SNAKE_CASE."""
    snake = "_".join(re.findall(r"[A-Za-z0-9]+", name)).upper()
    return HEADER_ALIASES.get(snake, snake)


# Month names in file names, in full or by their first three letters.
MONTHS = (
    "january february march april may june july august september october november december"
).split()


def snapshot_month(file_name: Column) -> Column:
    """First day of the month named at the end of a file name, NULL if there is none.

    Short and full English month names in any case are read (``_Oct2024.csv``,
    ``_october2024.csv``). This runs on every row of a scan, so it compares strings and
    leaves out patterns and date parsing, whose failures cost an exception each.
    """
    tail = F.lower(F.substring_index(file_name, "_", -1))
    word = F.substr(tail, F.lit(1), F.length(tail) - 8)
    year = F.substr(tail, F.length(tail) - 7, F.lit(4))
    names = F.array(*(F.lit(m) for m in MONTHS), *(F.lit(m[:3]) for m in MONTHS))
    place = F.array_position(names, word)
    number = F.pmod(place - 1, F.lit(12)) + 1
    valid = (
        file_name.contains("_")
        & tail.endswith(".csv")
        & (F.translate(year, "0123456789", "") == "")
        & (year > "0000")
        & (place > 0)
    )
    return F.when(valid, F.make_date(year.try_cast("int"), number.cast("int"), F.lit(1)))


def safe_name(name: Column) -> Column:
    """Slashes inside an item name would add path levels, so they become underscores."""
    return F.translate(name, "/\\", "__")


def normalize_prefix(prefix: str) -> str:
    """No leading slash, exactly one trailing slash; empty stays empty."""
    bare = prefix.strip().strip("/")
    return bare + "/" if bare else ""


def child_path(parent: Column, name: Column, is_folder: bool) -> Column:
    """Relative path under ``parent`` (which ends in ``/`` or is empty)."""
    return F.concat(parent, name, F.lit("/" if is_folder else ""))
