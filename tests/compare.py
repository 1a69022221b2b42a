"""Compares a registered query with its SQL in DuckDB, row by row."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_value(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


SPARK_TO_DUCK = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def differences(df, con, sql) -> list[str]:
    """What differs between a Spark result and its SQL; empty if nothing does."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    for name, kind in df.dtypes:
        if SPARK_TO_DUCK.get(kind) != kinds[name]:
            found.append(f"type of {name}: {kind} and {kinds[name]}")
    ours = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = sorted_rows(names, result.fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} and {len(theirs)} rows")
    elif ours != theirs:
        bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(bad)} rows differ, first: {bad[0]}")
    return found
