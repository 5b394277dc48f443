"""Comparison of a query with the SQL that stands for it."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def _tidy(value):
    return round(value, 6) if isinstance(value, float) else str(value)


def rows_of(df) -> Counter:
    columns = sorted(df.columns)
    return Counter(tuple(map(_tidy, r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())


def sql_rows(sql: str, directory: str) -> Counter:
    con = duckdb.connect()
    con.sql("SET timezone='UTC'")
    for path in glob.glob(f"{directory}/*.parquet"):
        at = path if os.path.isfile(path) else f"{path}/*.parquet"
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{at}'")
    relation = con.sql(sql)
    columns = sorted(relation.columns)
    return Counter(tuple(map(_tidy, r)) for r in relation.select(*[f'"{c}"' for c in columns]).fetchall())
