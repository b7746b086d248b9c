"""Schemas from short text, usable before any session exists."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "boolean": T.BooleanType(),
    "binary": T.BinaryType(),
}


def columns(text: str) -> T.StructType:
    """``"NAME type, NAME type"`` as a schema."""
    pairs = (part.split() for part in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])
