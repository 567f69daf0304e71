"""Runs a query and its SQL and compares the rows, in any order."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(folder) / f"{table}.parquet"
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, int):
        return value
    return str(value)


def rows(names, records) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in records)


def difference(df, con, sql: str) -> str:
    """Empty when the results agree."""
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    want = rows(names, cursor.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    if got == want:
        return ""
    columns = sorted(names)
    only_spark, only_sql = list((got - want))[:400], list((want - got))[:400]
    out = [f"{sum(got.values())} rows vs {sum(want.values())}; differing {sum((got - want).values())}"]
    key = lambda r: tuple(str(x) for x in r)
    for a, b in list(zip(sorted(only_spark, key=key), sorted(only_sql, key=key)))[:2]:
        out.append(str([(c, x, y, type(x).__name__, type(y).__name__) for c, x, y in zip(columns, a, b) if x != y or type(x) is not type(y)]))
    return "\n".join(out)
