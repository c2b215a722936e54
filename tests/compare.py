"""Run registered queries next to their SQL and compare whole results."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def tables(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]):
            df[name] = df[name].astype("datetime64[us]").astype("string")
        elif pd.api.types.is_float_dtype(df[name]):
            df[name] = (df[name] + 0.0).map(lambda v: None if pd.isna(v) else repr(v))
        else:
            df[name] = df[name].map(lambda v: None if v is None or v is pd.NA else str(v))
    return df.astype(object).where(df.notna(), None).sort_values(list(df.columns)).reset_index(drop=True)


def differences(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> str | None:
    """None when both hold the same rows, else what differs."""
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return f"rows {len(spark_df)} != {len(duck_df)}"
    a, b = _canonical(spark_df), _canonical(duck_df)
    bad = (a != b) & ~(a.isna() & b.isna())
    if not bad.any(axis=None):
        return None
    first = bad.any(axis=1).idxmax()
    return f"{int(bad.any(axis=1).sum())} rows differ, first: {a.loc[first].to_dict()} != {b.loc[first].to_dict()}"
