"""Run registered queries beside their SQL counterparts and compare the rows."""

from __future__ import annotations

import glob
import os
import time

import duckdb
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[:-len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), kind="mergesort").reset_index(drop=True) if len(df) else df


def difference(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    """None if equal (values compared exactly), else what differs first."""
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} / {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    a, b = normal(ours), normal(theirs)
    for column in a.columns:
        x, y = a[column], b[column]
        same = (x == y) | (x.isna() & y.isna())
        if not same.all():
            at = (~same).idxmax()
            return f"{column}: {(~same).sum()} differ, first {a.loc[at].to_dict()} / {b.loc[at].to_dict()}"
        if str(x.dtype) != str(y.dtype) and len(a) and not x.isna().any():
            return f"{column}: type {x.dtype} / {y.dtype}"
    return None


def compare(spark, folder: str, queries: dict, sql: dict, names=None) -> dict[str, str | None]:
    con, out = connect(folder), {}
    for name in names or queries:
        start = time.time()
        ours = queries[name](spark, folder).toPandas()
        middle = time.time()
        verdict = difference(ours, con.execute(sql[name]).df()) if name in sql else "no SQL"
        out[name] = verdict
        print(f"{name}: {'ok' if verdict is None else verdict} rows={len(ours)} "
              f"spark {middle - start:.1f}s sql {time.time() - middle:.1f}s", flush=True)
    return out
