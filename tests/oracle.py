"""Run a query and its SQL over the same tables and compare whole results."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return 0.0 if value == 0 else value
    if hasattr(value, "asDict"):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def run_sql(sql: str, sf_dir: str):
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    return {d[0]: str(d[1]) for d in result.description}, result.fetchall()


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(df, sql: str, sf_dir: str) -> tuple[int, str | None]:
    """Row count, and what differs (None when nothing does)."""
    got = _rows(df.columns, df.collect())
    types, rows = run_sql(sql, sf_dir)
    names = list(types)
    if sorted(names) != sorted(df.columns):
        return len(got), f"columns {sorted(df.columns)} != {sorted(names)}"
    differ = [f"{c}: {t} / {types[c]}" for c, t in df.dtypes if TYPES.get(t) != types[c]]
    if differ:
        return len(got), f"types {differ}"
    want = _rows(names, rows)
    if len(got) != len(want):
        return len(got), f"{len(got)} rows, SQL gives {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return len(got), f"{sorted(names)}\n  got  {g}\n  want {w}"
    return len(got), None
