"""Comparison of a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _cell(value):
    if isinstance(value, bool) or value is None:
        return repr(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
    return str(value)


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in data)


def spark_rows(df):
    return rows(df.columns, [tuple(r) for r in df.collect()])


def duckdb_rows(connection, sql):
    result = connection.execute(sql)
    return rows([d[0] for d in result.description], result.fetchall())


def difference(spark_result, duckdb_result) -> str | None:
    (a_cols, a), (b_cols, b) = spark_result, duckdb_result
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows; e.g. {str(a[:1])[:300]} / {str(b[:1])[:300]}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if not bad:
        return None
    x, y = bad[0]
    cells = [(c, p, q) for c, p, q in zip(a_cols, x, y) if p != q]
    name, p, q = cells[0]
    at = next((i for i, (m, n) in enumerate(zip(p, q)) if m != n), min(len(p), len(q)))
    return f"{len(bad)} rows differ; {name} at {at}: {p[max(0, at - 60):at + 60]!r} != {q[max(0, at - 60):at + 60]!r}"
