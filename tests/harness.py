"""Compares a registered query with its SQL statement on the same parquet files."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple((type(_plain(r[i])).__name__, _plain(r[i])) for i in order) for r in rows)


def difference(spark, con, sf_dir: str, query) -> str | None:
    """None when both sides agree in column names, types, row count and values."""
    df = query.run(spark, sf_dir)
    left_names, left = df.columns, [tuple(r) for r in df.collect()]
    if query.sql is None:
        return None
    result = con.execute(query.sql)
    right_names, right = [d[0] for d in result.description], result.fetchall()
    if sorted(left_names) != sorted(right_names):
        return f"columns {sorted(set(left_names) ^ set(right_names))}"
    a, b = _rows(left_names, left), _rows(right_names, right)
    if a == b:
        return None
    only_a, only_b = list((a - b).items())[:2], list((b - a).items())[:2]
    return f"rows {len(left)} / {len(right)}; differing {sum((a - b).values())}\n  {sorted(left_names)}\n  spark {only_a}\n  sql   {only_b}"
