"""Dictionary-driven typing and schema-drift union."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.clean import CLEANERS
from panelforge.functions.dictionaries import RESERVED, SnapshotFamily


def apply_dictionary(df: DataFrame, family: SnapshotFamily, reserved: Sequence[str] = RESERVED) -> DataFrame:
    """Clean every known column in one projection; unknown and ``reserved`` columns stay as they are."""
    unknown = sorted(set(df.columns) - set(family.kinds) - set(reserved))
    if unknown:
        warnings.warn(f"{family.label}: columns kept as text: {unknown}", stacklevel=2)

    def cleaned(name: str):
        column = F.col(f"`{name}`")
        kind = None if name in reserved else family.kinds.get(name)
        return CLEANERS[kind](column).alias(name) if kind else column

    return df.select(*map(cleaned, df.columns))


def union_drifting(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns in order of first appearance, absent ones NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
