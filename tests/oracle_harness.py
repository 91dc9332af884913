"""Spark-vs-DuckDB comparison in the driver's manner: row count, column names,
and an order-insensitive hash of the values (columns sorted by name)."""

from __future__ import annotations

import hashlib
import math

import duckdb

from florafold.session import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return f"{round(v, 6):.6f}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    try:
        import decimal
        if isinstance(v, decimal.Decimal):
            return f"{float(v):.6f}"
    except Exception:
        pass
    return str(v)


def digest(cols: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return len(lines), hashlib.sha1("\n".join(lines).encode()).hexdigest()


def compare(spark, con, name: str, fn, sql: str, sf_dir: str):
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    res = {"name": name, "spark_rows": len(s_rows), "duck_rows": len(d_rows),
           "cols_match": sorted(s_cols) == sorted(d_cols)}
    if not res["cols_match"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
    res["hash_match"] = digest(s_cols, s_rows) == digest(d_cols, d_rows)
    if not res["hash_match"]:
        so = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        do = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
        sl = sorted("|".join(_norm(r[i]) for i in so) for r in s_rows)
        dl = sorted("|".join(_norm(r[i]) for i in do) for r in d_rows)
        res["only_spark"] = sorted(set(sl) - set(dl))[:3]
        res["only_duck"] = sorted(set(dl) - set(sl))[:3]
    return res
