"""Side-by-side check of a Spark query against its DuckDB oracle SQL.

Mirrors the correctness gate: row count, column names, column types and an
order-insensitive hash of the values (columns sorted by name).
"""

from __future__ import annotations

import decimal
import hashlib
import math

import duckdb

from tramline.sources.tables import TABLE_NAMES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 6))
    if isinstance(v, decimal.Decimal):
        return format(v.normalize(), "f") if v == v else "NULL"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def _hash(rows: list[tuple]) -> str:
    lines = sorted("|".join(_norm(v) for v in r) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


_SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                  "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT", "date": "DATE",
                  "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, fn, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = dict(sdf.dtypes)
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    out = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "columns_match": sorted(s_cols) == sorted(d_cols)}
    if out["columns_match"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_d = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        out["hash_match"] = _hash([tuple(r[i] for i in order_s) for r in s_rows]) == \
            _hash([tuple(r[i] for i in order_d) for r in d_rows])
        mism = []
        for c in s_cols:
            st = s_types[c]
            want = _SPARK_TO_DUCK.get(st, st.upper().replace(" ", ""))
            got = d_types[c].replace(" ", "")
            if want.replace(" ", "") != got:
                mism.append((c, st, d_types[c]))
        out["type_mismatch"] = mism
    else:
        out["hash_match"] = False
        out["spark_columns"], out["oracle_columns"] = s_cols, d_cols
    out["ok"] = out["hash_match"] and out["spark_rows"] == out["oracle_rows"]
    return out
