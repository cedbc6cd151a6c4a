"""Runs a query and its SQL on the same Parquet tables and compares names, types and rows."""

from __future__ import annotations

import datetime
import decimal
from pathlib import Path

import duckdb

KINDS = {"int": "number", "bigint": "number", "smallint": "number", "double": "number", "float": "number", "string": "text", "boolean": "truth", "timestamp": "time"}


def plain(v):
    if isinstance(v, decimal.Decimal):
        return int(v) if v == int(v) else float(v)
    if isinstance(v, float):
        return float(f"{v:.10g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, query, sql: str, sf_dir: str) -> int:
    """The number of rows, after asserting that both sides agree."""
    frame = query(spark, sf_dir)
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    found = db.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(frame.columns) == sorted(names)
    theirs, own = rows_of(names, found.fetchall()), rows_of(frame.columns, map(tuple, frame.collect()))
    assert len(own) == len(theirs)
    for a, b in zip(own, theirs, strict=True):
        assert a == b
    return len(own)
