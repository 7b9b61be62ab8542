"""Spark-vs-DuckDB comparison used by the oracle tests and ``check.py``."""

from __future__ import annotations

import datetime as _dt
import math
import os
import sys

import numpy as np
import pandas as pd

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if REPO not in sys.path:
    sys.path.insert(0, REPO)

SF_SMALL = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_value(v):
    if v is None or v is pd.NaT or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if isinstance(v, (np.floating,)):
        f = float(v)
        return None if math.isnan(f) else f
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, (np.bool_, bool)):
        return bool(v)
    if isinstance(v, pd.Timestamp):
        if pd.isna(v):
            return None
        v = v.to_pydatetime()
    if isinstance(v, _dt.datetime):
        if v.hour == v.minute == v.second == v.microsecond == 0:
            return v.date().isoformat()
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm_value(x) for x in v)
    return v


def _rows(pdf: pd.DataFrame, cols):
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm_value(v) for v in rec))
    return out


def _sort_key(row):
    key = []
    for v in row:
        if v is None:
            key.append((0, ""))
        elif isinstance(v, bool):
            key.append((1, str(int(v))))
        elif isinstance(v, (int, float)):
            key.append((2, f"{round(float(v), 4):+020.4f}"))
        else:
            key.append((3, str(v)))
    return key


def _close(a, b, rel=1e-6, abs_=1e-6):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, bool) or isinstance(b, bool):
        return bool(a) == bool(b)
    if isinstance(a, (int, float)) and isinstance(b, (int, float)):
        return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=abs_)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y, rel, abs_) for x, y in zip(a, b))
    return a == b


def compare(spark_pdf: pd.DataFrame, oracle_pdf: pd.DataFrame, rel=1e-6) -> tuple[bool, str]:
    s_cols = sorted(spark_pdf.columns)
    o_cols = sorted(oracle_pdf.columns)
    if s_cols != o_cols:
        return False, f"columns differ: spark={s_cols} oracle={o_cols}"
    if len(spark_pdf) != len(oracle_pdf):
        return False, f"row count differs: spark={len(spark_pdf)} oracle={len(oracle_pdf)}"
    a = sorted(_rows(spark_pdf, s_cols), key=_sort_key)
    b = sorted(_rows(oracle_pdf, s_cols), key=_sort_key)
    bad = 0
    first = None
    for ra, rb in zip(a, b):
        if not all(_close(x, y, rel) for x, y in zip(ra, rb)):
            bad += 1
            if first is None:
                first = (ra, rb)
    if bad:
        return False, f"{bad} rows differ; first spark={first[0]} oracle={first[1]} cols={s_cols}"
    return True, f"{len(a)} rows match"
