"""Spark-vs-DuckDB comparison, mirroring the driver's correctness gate."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.quantize(decimal.Decimal("0.01"))) if v == v.quantize(
            decimal.Decimal("0.01")) else str(v.normalize())
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date, dt.time)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


_DUCK = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def spark_type_as_duck(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper()
    return _DUCK.get(t, t)


def compare(spark_df, con, sql: str) -> dict:
    cols_s = sorted(spark_df.columns)
    srows = [tuple(_norm(r[c]) for c in cols_s) for r in spark_df.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    cols_d = sorted(dcols)
    idx = [dcols.index(c) for c in cols_d]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "columns_match": cols_s == cols_d}
    stypes = {f.name: spark_type_as_duck(f.dataType.simpleString()) for f in spark_df.schema.fields}
    dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
    bad_types = {c: (stypes.get(c), dtypes.get(c)) for c in cols_s
                 if stypes.get(c) != dtypes.get(c)}
    out["types_match"] = not bad_types
    if bad_types:
        out["type_diffs"] = bad_types
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = cols_s, cols_d
    ss, ds = sorted(srows, key=_key), sorted(drows, key=_key)
    out["values_match"] = ss == ds
    if not out["values_match"]:
        sset, dset = set(ss), set(ds)
        out["only_spark"] = list(sset - dset)[:3]
        out["only_oracle"] = list(dset - sset)[:3]
    out["ok"] = out["columns_match"] and out["values_match"] and out["types_match"]
    return out
