"""Run a registered query in Spark and its SQL oracle in DuckDB; compare as multisets."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    """One spelling for each value: numbers as numbers, NaN apart from NULL."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, (int, float, decimal.Decimal)):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.isoformat()
    if isinstance(v, dt.date):
        return dt.datetime(v.year, v.month, v.day).isoformat()
    return str(v)


def canon_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def run(spark, name: str, sf_dir: str, queries, oracle) -> dict:
    df = queries[name](spark, sf_dir)
    ours = df.collect()
    con = duck(sf_dir)
    cursor = con.execute(oracle[name])
    columns = [c[0] for c in cursor.description]
    theirs = cursor.fetchall()
    out = {"spark_rows": len(ours), "oracle_rows": len(theirs), "spark_cols": sorted(df.columns), "oracle_cols": sorted(columns)}
    out["cols_match"], out["rows_match"] = out["spark_cols"] == out["oracle_cols"], len(ours) == len(theirs)
    a, b = canon_rows(df.columns, ours), canon_rows(columns, theirs)
    out["values_match"] = out["cols_match"] and a == b
    ca, cb = Counter(a), Counter(b)
    out["examples"] = {"spark_only": list((ca - cb).elements())[:3], "oracle_only": list((cb - ca).elements())[:3],
                       "cols": sorted(df.columns)}
    return out
