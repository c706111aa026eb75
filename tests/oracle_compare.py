"""Run a Spark query and its SQL on the same files and compare the row multisets."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def sql_rows(con, sql: str):
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return sorted(columns), rows, types


def spark_rows(df):
    columns = sorted(df.columns)
    rows = Counter(tuple(_plain(v) for v in row) for row in df.select(*columns).collect())
    return columns, rows, dict(df.dtypes)
