"""Spark result against DuckDB result, as multisets of rows."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from pathlib import Path

import duckdb

KIND = {
    "string": "VARCHAR",
    "double": "DOUBLE",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET threads = 4")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def difference(frame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both give the same columns, types and rows, else what differs."""
    relation = connection.sql(sql)
    theirs = dict(zip(relation.columns, (str(t) for t in relation.types)))
    ours = {name: KIND.get(kind, kind) for name, kind in frame.dtypes}
    whole = {"INTEGER", "BIGINT"}
    for name in sorted(set(ours) | set(theirs)):
        a, b = ours.get(name), theirs.get(name)
        if a != b and not {a, b} <= whole:
            return f"column {name}: {a} against {b}"
    names = sorted(ours)
    left = Counter(tuple(_plain(row[n]) for n in names) for row in frame.select(*names).collect())
    listed = ", ".join(f'"{n}"' for n in names)
    right = Counter(tuple(_plain(v) for v in row) for row in connection.sql(f"SELECT {listed} FROM ({sql})").fetchall())
    if left == right:
        return None
    only_left, only_right = list((left - right).items()), list((right - left).items())
    return (
        f"{sum(left.values())} against {sum(right.values())} rows; columns {names}; "
        f"only Spark {len(only_left)}: {only_left[:3]}; only DuckDB {len(only_right)}: {only_right[:3]}"
    )
