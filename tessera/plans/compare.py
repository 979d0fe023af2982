"""Run named queries on Spark and their SQL on DuckDB, and compare rows, columns and values."""

from __future__ import annotations

import math
import time

import numpy as np
import pandas as pd

from tessera.sources.tables import TABLES


def duckdb_connection(data_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{data_dir}/{name}.parquet')")
    return con


def _is_null(v) -> bool:
    return v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v))


def _normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for rec in df[cols].itertuples(index=False, name=None):
        rows.append(tuple(None if _is_null(v) else (float(v) if isinstance(v, float) else int(v) if isinstance(v, np.integer) else v) for v in rec))
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def compare(spark, con, name: str, query, sql: str | None, data_dir: str) -> dict:
    t0 = time.time()
    sdf = query(spark, data_dir)
    got = sdf.toPandas()
    t1 = time.time()
    res = {"query": name, "rows": len(got), "spark_sec": round(t1 - t0, 3)}
    if sql is None:
        res["match"] = None
        return res
    want = con.sql(sql).df()
    res["oracle_rows"] = len(want)
    res["columns_match"] = sorted(got.columns) == sorted(want.columns)
    if not res["columns_match"]:
        res["match"] = False
        res["detail"] = f"{sorted(got.columns)} vs {sorted(want.columns)}"
        return res
    # a column of whole numbers and nulls comes as floats from one side or the other
    for c in got.columns:
        if dict(sdf.dtypes)[c] == "bigint":
            got[c], want[c] = got[c].astype("Int64"), want[c].astype("Int64")
    a, b = _normalise(got), _normalise(want)
    res["match"] = a == b
    if not res["match"]:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        res["detail"] = f"first diffs: {diff}"
    return res
