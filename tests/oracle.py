"""Compare Spark results with DuckDB's, row for row."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return db


def _plain(value):
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.UTC).replace(tzinfo=None)
    return value


def rows(names: list[str], data) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in data)


def compare(frame, db: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list, list]:
    """Row count, and samples of rows only Spark and only DuckDB have."""
    got = rows(frame.columns, frame.collect())
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(frame.columns), (names, frame.columns)
    expected = rows(names, cursor.fetchall())
    return sum(got.values()), list((got - expected).items())[:3], list((expected - got).items())[:3]
