"""Spark-vs-DuckDB comparison used by the tests and ``scripts/check_oracle.py``.

Mirrors the acceptance check: row count, column names, a type family per
column, and an order-insensitive comparison of the values (columns sorted by
name, rows sorted, doubles compared exactly as produced).
"""

from __future__ import annotations

import math
import os

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _family(dtype: str) -> str:
    d = str(dtype).lower()
    if any(x in d for x in ("int", "long", "short", "byte", "hugeint")):
        return "int"
    if any(x in d for x in ("double", "float", "real", "decimal")):
        return "float"
    if any(x in d for x in ("char", "string", "text")):
        return "str"
    if "bool" in d:
        return "bool"
    if "timestamp" in d or "date" in d:
        return "time"
    return d


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, oracle: str, con: duckdb.DuckDBPyConnection) -> dict:
    sp = spark_df.toPandas()
    rel = con.execute(oracle)
    names = [d[0] for d in rel.description]
    dk = pd.DataFrame(rel.fetchall(), columns=names)
    out = {"spark_rows": len(sp), "oracle_rows": len(dk)}
    out["columns_match"] = sorted(sp.columns) == sorted(dk.columns)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(sp.columns), sorted(dk.columns)
        out["ok"] = False
        return out
    duck_types = {n: _family(t) for n, t in zip(names, [str(d[1]) for d in rel.description])}
    spark_types = {f.name: _family(f.dataType.simpleString()) for f in spark_df.schema.fields}
    out["type_mismatch"] = {c: (spark_types[c], duck_types[c]) for c in spark_types
                            if spark_types[c] != duck_types.get(c) and duck_types.get(c) not in ("number",)}
    a, b = _rows(sp), _rows(dk)
    out["values_match"] = a == b
    if not out["values_match"] and len(a) == len(b):
        diffs = [(x, y) for x, y in zip(a, b) if x != y]
        out["n_diff"] = len(diffs)
        out["example"] = diffs[:2]
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"] and not out["type_mismatch"]
    return out
