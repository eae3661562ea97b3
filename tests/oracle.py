"""Compare a registered query with its oracle SQL: names, row count and exact values."""

from __future__ import annotations

import datetime as dt
import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    if value is not None and not isinstance(value, (bool, int, str)):
        return repr(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, name, registered, sf_dir, con) -> str | None:
    """None when equal, else what differs."""
    started = time.time()
    df = registered(spark, sf_dir)
    got = df.collect()
    spark_s = time.time() - started
    started = time.time()
    cursor = con.execute(registered.sql)
    names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    oracle_s = time.time() - started
    if os.environ.get("ORACLE_TIMES"):
        print(f"  {name}: spark {spark_s:.1f}s oracle {oracle_s:.1f}s rows {len(got)}")
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows vs {len(want)}"
    a, b = _rows(df.columns, got), _rows(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y or [type(i) for i in x] != [type(i) for i in y]]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ ({sorted(names)}), e.g. {bad[:2]}"
    return None
