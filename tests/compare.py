"""Compare a Spark result with DuckDB's answer to the oracle SQL, value by value."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

KINDS = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def differences(result, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs; empty when types and all values, whatever their order, agree."""
    expected = db.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    if sorted(names) != sorted(result.columns):
        return [f"columns {sorted(result.columns)} expected {sorted(names)}"]
    found = []
    for name, kind in result.dtypes:
        if KINDS.get(kind, kind) != kinds[name]:
            found.append(f"type of {name}: {kind} expected {kinds[name]}")
    order = sorted(names)
    places = [names.index(n) for n in order]
    theirs = Counter(tuple(_plain(r[i]) for i in places) for r in expected.fetchall())
    ours = Counter(tuple(_plain(r[n]) for n in order) for r in result.collect())
    if ours != theirs:
        found.append(f"{ours.total()} rows, expected {theirs.total()}")
        found.append(f"only ours: {list((ours - theirs).items())[:3]}")
        found.append(f"only expected: {list((theirs - ours).items())[:3]}")
    return found
