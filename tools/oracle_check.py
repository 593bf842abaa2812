"""Run catalogue queries in Spark and their oracles in DuckDB; compare.

Usage: python tools/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-free multiset of rows
(floats rounded to 6 significant digits).
"""

from __future__ import annotations

import datetime as _dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from emporia.sources.tables import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.6g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.6g}")
    if isinstance(v, (_dt.datetime, _dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, bool):
        return int(v)
    return v


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(norm(x) for x in r) for r in sdf.collect()]
    t1 = time.time()
    res = con.sql(sql)
    d_cols = res.columns
    d_rows = [tuple(norm(x) for x in r) for r in res.fetchall()]
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={s_cols} duck={d_cols}", t1 - t0
    order = [d_cols.index(c) for c in s_cols]
    d_rows = [tuple(r[i] for i in order) for r in d_rows]
    if len(s_rows) != len(d_rows):
        return False, f"rows differ: spark={len(s_rows)} duck={len(d_rows)}", t1 - t0
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    a, b = sorted(s_rows, key=key), sorted(d_rows, key=key)
    for ra, rb in zip(a, b):
        if ra != rb:
            return False, f"value differs: spark={ra} duck={rb}", t1 - t0
    return True, f"{len(s_rows)} rows", t1 - t0


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    from emporia.session import get_session
    from emporia.plans import ORACLES, QUERIES
    spark = get_session("local[3]", shuffle_partitions=8)
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(QUERIES):
        if name not in ORACLES:
            print(f"{name:32s} NO-ORACLE")
            continue
        try:
            ok, msg, dt = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
        except Exception as e:  # report and go on
            ok, msg, dt = False, f"error: {type(e).__name__}: {str(e)[:400]}", 0.0
        bad += not ok
        print(f"{name:32s} {'OK ' if ok else 'BAD'} {dt:6.2f}s {msg}", flush=True)
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
