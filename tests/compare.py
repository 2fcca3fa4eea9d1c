"""Run a registered query on Spark and its SQL on DuckDB and compare whole results."""

from __future__ import annotations

import datetime as dt
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return round(value, 9) + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(names, records):
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(record[i]) for i in order) for record in records]
    return sorted(rows, key=lambda row: [(v is None, str(type(v)), v if v is not None else 0) for v in row])


_KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def differences(spark, con, query, sql: str, sf_dir: str) -> list[str]:
    """What differs between both engines; empty when names, types and rows agree."""
    df = query(spark, sf_dir)
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: _KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    for name, kind in df.dtypes:
        if kind != kinds[name]:
            found.append(f"type of {name}: {kind} / {kinds[name]}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(names, result.fetchall())
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} / {len(theirs)}")
    unequal = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if unequal:
        found.append(f"{len(unequal)} unequal rows, first {unequal[0]}")
    return found
