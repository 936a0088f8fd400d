"""Side-by-side comparison of a Spark result and the same query in DuckDB."""

from __future__ import annotations

import math
from datetime import date, datetime

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, date):
        return v.isoformat()
    return v


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_value(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


KIND = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp": "TIMESTAMP WITH TIME ZONE",
    "timestamp_ntz": "TIMESTAMP",
}


def compare(spark_df, con, sql):
    """Differences as a list of messages; empty when all agree."""
    got_cols, got = normalised(spark_df.columns, spark_df.collect())
    rel = con.sql(sql)
    want_cols, want = normalised(rel.columns, rel.fetchall())
    problems = []
    if got_cols != want_cols:
        problems.append(f"columns {got_cols} != {want_cols}")
    types = dict(zip(rel.columns, [str(t) for t in rel.types], strict=True))
    for name, dtype in spark_df.dtypes:
        if types.get(name) != KIND.get(dtype, dtype):
            problems.append(f"type of {name}: {dtype} != {types.get(name)}")
    if len(got) != len(want):
        problems.append(f"rows {len(got)} != {len(want)}")
    if got != want:
        a, b = set(map(repr, got)), set(map(repr, want))
        problems.append(f"only in Spark: {sorted(a - b)[:3]}; only in SQL: {sorted(b - a)[:3]}")
    return problems
