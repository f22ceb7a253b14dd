"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Comparison: row count, column names, and the multiset of rows (columns sorted
by name, values normalised) — the same shape of check the driver makes.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return repr(float(v))
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return v


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


# Spark type name -> DuckDB type name, for the schema part of the check
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = {c: TYPES.get(t, t) for c, t in sdf.dtypes}
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = dict(zip(d_cols, [str(t) for t in rel.types]))
    d_rows = rel.fetchall()
    t2 = time.time()
    sc, sr = canon(s_cols, s_rows)
    dc, dr = canon(d_cols, d_rows)
    ok = sc == dc and sr == dr and s_types == d_types
    detail = ""
    if sc != dc:
        detail = f"cols spark={sc} duck={dc}"
    elif s_types != d_types:
        detail = f"types {[(c, s_types[c], d_types.get(c)) for c in s_types if s_types[c] != d_types.get(c)]}"
    elif len(sr) != len(dr):
        detail = f"rows spark={len(sr)} duck={len(dr)}"
    elif sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:2]
        detail = f"first diffs {diff}"
    return ok, len(s_rows), t1 - t0, t2 - t1, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    from encore.session import build_session
    import __spark_entry__ as entry
    spark = build_session("local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for key, fn in qs.items():
        if only and key not in only:
            continue
        if key not in sqls:
            print(f"{key:28s} (no oracle)")
            continue
        try:
            ok, n, ts, td, detail = compare(spark, con, key, fn, sqls[key], sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, n, ts, td, detail = False, -1, 0, 0, f"ERROR {str(e)[:400]}"
        bad += not ok
        print(f"{key:28s} {'OK ' if ok else 'BAD'} rows={n:6d} spark={ts:5.2f}s duck={td:5.2f}s {detail}"[:700])
    print(f"mismatches: {bad}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
