"""Runs a bound query and its SQL side by side and compares rows as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "NaN"
        return repr(value + 0.0)
    if isinstance(value, decimal.Decimal):
        return repr(float(value))
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return str(value)


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda at: names[at])
    return [names[at] for at in order], sorted(tuple(plain(row[at]) for at in order) for row in rows)


def differences(spark, folder: str, query, sql: str, con=None) -> list[str]:
    df = query(spark, folder)
    ours = canonical(df.columns, [tuple(row) for row in df.collect()])
    cursor = (con or connect(folder)).execute(sql)
    theirs = canonical([part[0] for part in cursor.description], cursor.fetchall())
    if ours[0] != theirs[0]:
        return [f"columns {ours[0]} against {theirs[0]}"]
    if len(ours[1]) != len(theirs[1]):
        return [f"{len(ours[1])} rows against {len(theirs[1])}", f"{ours[1][:2]}", f"{theirs[1][:2]}"]
    wrong = [(a, b) for a, b in zip(*(side[1] for side in (ours, theirs))) if a != b]
    return [f"{len(wrong)} rows differ"] + [f"\n  {a}\n  {b}" for a, b in wrong[:3]] if wrong else []
