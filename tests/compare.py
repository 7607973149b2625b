"""Compare a Spark result with a DuckDB answer: columns by name, rows in any order, values exactly."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime

import duckdb

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TEST_TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day).isoformat()
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(row[n]) for n in names) for row in df.select(*names).collect())


def duck_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    found = [d[0] for d in result.description]
    names = sorted(found)
    places = [found.index(n) for n in names]
    return names, Counter(tuple(plain(row[p]) for p in places) for row in result.fetchall())
