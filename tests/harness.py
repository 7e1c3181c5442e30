"""Compare queries with their oracles: columns, types, rows, values."""

from __future__ import annotations

import datetime
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


KINDS = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean",
}


def _norm(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def compare(spark, con, name, build, sql, directory):
    """None when equal, else a description of the difference."""
    t0 = time.time()
    df = build(spark, directory)
    columns = sorted(df.columns)
    ours = [tuple(_norm(row[c]) for c in columns) for row in df.collect()]
    t1 = time.time()
    found = con.execute(sql)
    described = {d[0]: str(d[1]) for d in found.description}
    names = [d[0] for d in found.description]
    rows = found.fetchall()
    t2 = time.time()
    timing = f"spark {t1 - t0:.2f}s sql {t2 - t1:.2f}s"
    if sorted(names) != columns:
        return f"columns {columns} vs {sorted(names)}", timing
    kinds = {c: k for c, k in df.dtypes}
    odd = [(c, kinds[c], described[c]) for c in columns if KINDS.get(described[c]) != kinds[c]]
    at = [names.index(c) for c in columns]
    theirs = [tuple(_norm(row[i]) for i in at) for row in rows]
    key = lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)
    if len(ours) != len(theirs):
        only = list(set(ours) - set(theirs))[:2], list(set(theirs) - set(ours))[:2]
        return f"rows {len(ours)} vs {len(theirs)} {only}", timing
    a, b = sorted(ours, key=key), sorted(theirs, key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[0]}", timing
    if odd:
        return f"types {odd}", timing
    if not ours:
        return "no rows", timing
    return None, timing
