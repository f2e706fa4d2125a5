"""Spark-vs-DuckDB comparison used by the tests (mirrors the driver's check)."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, Decimal):
        return round(float(v), 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist") and not isinstance(v, (str, bytes)):
        return tuple(_norm(x) for x in v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if pd.isna(v) if not isinstance(v, (list, tuple, dict)) else False:
        return None
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = [tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark_df, con, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = con.sql(sql).df()
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = rows(s), rows(d)
    for a, b in zip(rs, rd):
        if a != b:
            return False, f"first diff: {a} vs {b}"
    return True, f"{len(s)} rows"
