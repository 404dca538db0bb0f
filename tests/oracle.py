"""Side-by-side run of registered queries and their SQL twins."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
DATA = os.environ.get("TABLELAB_TESTDATA", "/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return repr(float(v))
    return str(v)


def _rows(frame):
    frame = frame[sorted(frame.columns)].astype(object)
    return sorted(tuple(_cell(v) for v in row) for row in frame.itertuples(index=False, name=None))


def differences(spark_df, con, sql: str, shown: int = 3) -> list[str]:
    ours, theirs = spark_df.toPandas(), con.execute(sql).fetchdf()
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} against {sorted(theirs.columns)}"]
    if len(ours) != len(theirs):
        return [f"{len(ours)} rows against {len(theirs)}"]
    out = []
    for a, b in zip(_rows(ours), _rows(theirs)):
        if a != b:
            out.append(f"{a}\n  against {b}")
            if len(out) == shown:
                break
    return out
