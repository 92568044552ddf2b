"""Compares a query with its SQL on DuckDB, values as text."""

import os

import duckdb
import numpy as np
import pandas as pd


def rows(df: pd.DataFrame) -> list[tuple]:
    def one(x):
        if x is None or x is pd.NA or isinstance(x, float) and np.isnan(x):
            return ""
        if isinstance(x, (float, np.floating)):
            return f"{x:.4f}"
        if isinstance(x, (int, np.integer)) and not isinstance(x, (bool, np.bool_)):
            return f"{float(x):.4f}"
        return str(x)

    return sorted(tuple(one(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False))


def connect(d: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in os.listdir(d):
        con.execute(f"create view {f.split('.')[0]} as select * from read_parquet('{d}/{f}')")
    return con
