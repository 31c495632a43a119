"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from datetime import date, datetime
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or isinstance(value, (str, bool, datetime, date)):
        return value
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return float(value)


def _key(row):
    return tuple("" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v) for v in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=_key)


def differences(spark_df, con, sql: str, limit: int = 3) -> list[str]:
    """Human-readable differences; empty when the results agree."""
    cursor = con.execute(sql)
    theirs_cols = [c[0] for c in cursor.description]
    theirs = _rows(theirs_cols, cursor.fetchall())
    ours_cols = list(spark_df.columns)
    if sorted(ours_cols) != sorted(theirs_cols):
        return [f"columns {sorted(ours_cols)} != {sorted(theirs_cols)}"]
    ours = _rows(ours_cols, spark_df.collect())
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} != {len(theirs)}"]
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return [f"{len(bad)} of {len(ours)} rows differ"] * bool(bad) + [f"spark {a}\nduck  {b}" for a, b in bad[:limit]]
