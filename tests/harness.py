"""Spark-vs-DuckDB comparison, modelled on the driver's correctness gate:
column names, row count, column types and order-insensitive values."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

SPARK_TO_DUCK = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT",
    "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP",
}


def duck_connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (0, "")
        return (1, v)
    return (1, str(v) if not isinstance(v, (int,)) else v)


def _rows(cols, records):
    return sorted(tuple(_norm(r[c]) for c in cols) for r in records)


def compare(spark_df, sql: str, con, tol: float = 0.0) -> dict:
    """Return a report dict with ok flag and details."""
    s_cols = spark_df.columns
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    s_rows = [r.asDict() for r in spark_df.collect()]
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    d_vals = rel.fetchall()
    d_rows = [dict(zip(d_cols, v)) for v in d_vals]
    rep = {"spark_rows": len(s_rows), "duck_rows": len(d_rows), "ok": False}
    if sorted(s_cols) != sorted(d_cols):
        rep["error"] = f"columns differ: spark={sorted(s_cols)} duck={sorted(d_cols)}"
        return rep
    type_diff = {c: (s_types[c], d_types[c]) for c in s_cols
                 if SPARK_TO_DUCK.get(s_types[c], s_types[c]) != d_types[c]}
    rep["type_diff"] = type_diff
    if len(s_rows) != len(d_rows):
        rep["error"] = "row count differs"
        return rep
    cols = sorted(s_cols)
    a, b = _rows(cols, s_rows), _rows(cols, d_rows)
    exact = a == b
    rep["exact"] = exact
    if not exact:
        bad = 0
        first = None
        for x, y in zip(a, b):
            for (fx, vx), (fy, vy) in zip(x, y):
                if fx != fy:
                    same = False
                elif isinstance(vx, float) or isinstance(vy, float):
                    same = abs(float(vx) - float(vy)) <= tol
                else:
                    same = vx == vy
                if not same:
                    bad += 1
                    first = first or (x, y)
                    break
        rep["rows_differ"] = bad
        rep["first_diff"] = first
        rep["ok"] = bad == 0 and not type_diff
    else:
        rep["ok"] = not type_diff
    return rep
