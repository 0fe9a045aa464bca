"""Run a query and its SQL check side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    try:
        return round(float(value), 9)
    except (TypeError, ValueError):
        return str(value)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows), key=repr
    )


def compare(df, con, sql):
    """Assert that both sides give the same columns and rows; return the count."""
    ours = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    names, theirs = [c[0] for c in result.description], result.fetchall()
    assert kinds(df.columns, ours) == kinds(names, theirs)
    left, right = _table(df.columns, ours), _table(names, theirs)
    assert left[0] == right[0], (left[0], right[0])
    assert len(left[1]) == len(right[1]), (len(left[1]), len(right[1]))
    for a, b in zip(left[1], right[1]):
        assert a == b, (a, b)
    return len(left[1])


def kinds(names, rows):
    """The Python types of each column's values."""
    return {
        name: sorted({type(row[i]).__name__ for row in rows if row[i] is not None})
        for i, name in enumerate(names)
    }
