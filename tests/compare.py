"""Run a query and its SQL on the same tables and compare all rows."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, (int, float)) or hasattr(value, "as_tuple"):
        number = float(value)
        if math.isnan(number):
            return "NaN"
        return int(number) if number == int(number) and abs(number) < 1e15 else number
    return str(value)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def differences(con, sql: str, df) -> list[str]:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    got = _rows(df.columns, df.collect())
    if len(got) != len(expected):
        return [f"{len(got)} rows != {len(expected)}"]
    return [f"{g} != {e}" for g, e in zip(got, expected) if g != e]
