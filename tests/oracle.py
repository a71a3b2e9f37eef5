"""Compares a query's rows with its SQL's, columns by name and rows in any order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(frame: pd.DataFrame) -> list[tuple]:
    def cell(v):
        if hasattr(v, "tolist"):
            v = v.tolist()
        if v is None or v is pd.NA or v is pd.NaT or v != v:
            return "null"
        return str(round(v, 6)) if isinstance(v, float) else str(v)

    return sorted(tuple(cell(v) for v in row) for row in frame[sorted(frame.columns)].itertuples(index=False))


def same(spark, folder: str, query, sql: str) -> None:
    db = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        db.sql(f"create view {t} as from read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    got, want = query(spark, folder).toPandas(), db.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)
