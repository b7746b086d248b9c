"""Compare a Spark result with DuckDB, order-insensitively and type by type."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "FLOAT": "float",
}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(table, key=lambda r: [(x is None, str(x)) for x in r])


def compare(result, sql: str, con) -> list[str]:
    """Differences found, empty if none."""
    relation = con.sql(sql)
    problems = []
    if sorted(result.columns) != sorted(relation.columns):
        return [f"columns {sorted(result.columns)} against {sorted(relation.columns)}"]
    have = dict(result.dtypes)
    for name, kind in zip(relation.columns, map(str, relation.types), strict=True):
        if TYPES.get(kind, kind) != have[name]:
            problems.append(f"type of {name}: {have[name]} against {kind}")
    mine = _rows(result.columns, [tuple(r) for r in result.collect()])
    other = _rows(relation.columns, relation.fetchall())
    if len(mine) != len(other):
        problems.append(f"{len(mine)} rows against {len(other)}")
    wrong = [(a, b) for a, b in zip(mine, other) if a != b]
    if wrong:
        problems.append(f"{len(wrong)} rows differ, e.g. {wrong[:2]}")
    return problems
