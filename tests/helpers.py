"""Comparison of Spark frames with an independent engine's results."""

import os

import pandas as pd


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        if f.endswith(".parquet"):
            con.sql(f"create view {f[:-8]} as select * from '{sf_dir}/{f}'")
    return con


def canonical(frame: pd.DataFrame) -> list[tuple]:
    cols = sorted(frame.columns)
    got = frame[cols].astype(object).where(frame[cols].notna(), None)
    return sorted((tuple(r) for r in got.values.tolist()), key=repr)


def assert_same(con, sql: str, df) -> None:
    rel = con.sql(sql)
    want = pd.DataFrame(rel.fetchall(), columns=rel.columns)
    got = df.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)
