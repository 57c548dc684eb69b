"""Compare a registered query with its SQL on the supplied tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from caseloom.sources.tables import TABLES


def connection(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else ("f", repr(value))
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, int):
        return ("i", value)
    if isinstance(value, dt.datetime):
        return ("t", value.isoformat())
    if isinstance(value, dt.date):
        return ("day", value.isoformat())
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((repr(tuple(_plain(r[i]) for i in order)) for r in rows))


def differences(spark, con, fn, sql: str, folder: str) -> str:
    """Empty text when both sides agree on names, row count and every value."""
    df = fn(spark, folder)
    ours = _table(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = _table(names, cursor.fetchall())
    if not theirs[1]:
        return "no rows: nothing is compared"
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} != {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} != {len(theirs[1])}"
    wrong = [(a, b) for a, b in zip(ours[1], theirs[1], strict=True) if a != b]
    return "" if not wrong else f"{len(wrong)} of {len(ours[1])} rows differ, e.g.\n  {wrong[0][0]}\n  {wrong[0][1]}"
