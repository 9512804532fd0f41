"""Compares query results with DuckDB on the same tables."""

import glob
import os
from collections import Counter

import duckdb
import pandas as pd


def connection(sf_dir):
    c = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        source = path + "/*.parquet" if os.path.isdir(path) else path
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return c


def _value(v):
    if not hasattr(v, "__len__") and pd.isna(v):
        return None
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def counted(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), Counter(tuple(_value(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def same(df, connection_, sql):
    ours, theirs = counted(df.toPandas()), counted(connection_.execute(sql).df())
    assert ours[0] == theirs[0]
    assert ours[1] == theirs[1], (list((ours[1] - theirs[1]).items())[:3], list((theirs[1] - ours[1]).items())[:3])
