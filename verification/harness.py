"""Side-by-side check of a registered query and its SQL on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(base: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{base}/{name}.parquet"):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{base}/{name}.parquet')")
    return db


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    return sorted(names), _rows(names, cursor.fetchall())


def differences(got, want) -> list[str]:
    """Exact comparison; an empty list means equal names, counts, types and values."""
    (names, rows), (want_names, want_rows) = got, want
    if names != want_names:
        return [f"columns {names} != {want_names}"]
    out = []
    if len(rows) != len(want_rows):
        out.append(f"{len(rows)} rows != {len(want_rows)}")
    for a, b in zip(rows, want_rows):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            out.append(f"{a}\n    != {b}   {names}")
            if len(out) > 3:
                break
    return out
