"""Runs a registered query in Spark and its SQL in DuckDB and compares them by value."""

from __future__ import annotations

import time

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    text = df.map(lambda v: repr(float(v)) if isinstance(v, float) else str(v)) if len(df) else df
    order = text.sort_values(list(text.columns)).index if len(df) else df.index
    return df.loc[order].reset_index(drop=True)


def differences(spark_df, con, sql: str, seconds: list | None = None) -> str | None:
    """None when both sides agree, else a short description; ``seconds`` collects the SQL's time."""
    left = canonical(spark_df.toPandas())
    start = time.time()
    right = canonical(con.execute(sql).df())
    if seconds is not None:
        seconds.append(time.time() - start)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} != {list(right.columns)}"
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    for c in left.columns:
        a, b = left[c], right[c]
        kinds = (a.dtype.kind, b.dtype.kind)
        if len(a) and kinds[0] != kinds[1] and not (a.isna().any() or b.isna().any()):
            return f"{c}: type {a.dtype} != {b.dtype}"
        same = (a.isna() & b.isna()) | (a.astype(object) == b.astype(object))
        if not same.all():
            i = int((~same).idxmax())
            return f"{c}: {int((~same).sum())} differ, first row {i}: spark {dict(left.loc[i])} oracle {dict(right.loc[i])}"
    return None
