"""Run a registered query in Spark and its statement in DuckDB, and list the differences."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and math.isnan(v)) or v is pd.NA:
        return None
    if isinstance(v, float):
        return float(repr(round(v, 9))) + 0.0
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v.item() if hasattr(v, "item") else v


def rows(records, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def differences(spark_df, con, sql: str, show: int = 3) -> list[str]:
    rel = con.execute(sql)
    expected_cols = [d[0] for d in rel.description]
    expected = rel.fetchall()
    got = [tuple(r) for r in spark_df.collect()]
    problems = []
    if sorted(spark_df.columns) != sorted(expected_cols):
        return [f"columns {sorted(set(spark_df.columns) ^ set(expected_cols))}"]
    if len(got) != len(expected):
        problems.append(f"rows {len(got)} != {len(expected)}")
    a, b = rows(got, spark_df.columns), rows(expected, expected_cols)
    names = sorted(expected_cols)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ")
        for x, y in bad[:show]:
            problems.append(str({n: (p, q) for n, p, q in zip(names, x, y) if p != q}))
    return problems
