"""Compare a Spark result with a DuckDB result: names, types, and values as multisets."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
]

SAME_TYPE = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str, sql: str) -> tuple[list[str], list[str], list[tuple]]:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names, types = [d[0] for d in cur.description], [str(d[1]) for d in cur.description]
    return names, types, cur.fetchall()


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 4) + 0.0
    return v


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df, sf_dir: str, sql: str) -> list[str]:
    names, types, rows = duck(sf_dir, sql)
    expected_types = dict(zip(names, types))
    found = []
    if sorted(df.columns) != sorted(names):
        return [f"columns: {sorted(df.columns)} / {sorted(names)}"]
    for name, dtype in df.dtypes:
        if SAME_TYPE.get(dtype) != expected_types[name]:
            found.append(f"type of {name}: {dtype} / {expected_types[name]}")
    ours, theirs = _rows(df.columns, df.collect()), _rows(names, rows)
    if ours != theirs:
        found.append(f"rows: {sum(ours.values())} / {sum(theirs.values())}")
        found.append(f"only Spark: {list((ours - theirs).items())[:3]}")
        found.append(f"only SQL: {list((theirs - ours).items())[:3]}")
    return found
