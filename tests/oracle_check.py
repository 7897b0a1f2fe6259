"""Run registered queries in Spark and their oracle SQL in DuckDB on the same
parquet tables; compare row count, column names and sorted rounded values.

usage: python tests/oracle_check.py [sf_dir] [name ...]
"""
from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from podium.session import get_session  # noqa: E402
from podium.sources.views import TABLES  # noqa: E402


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 5)
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, (int, bool, str)):
        return v
    return str(v)


def key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def compare(name, sdf, con, sql):
    t0 = time.time()
    cols = sdf.columns
    srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows_raw = res.fetchall()
    if sorted(dcols) != sorted(cols):
        return False, f"columns differ spark={cols} duck={dcols}", t1 - t0
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} duck={len(drows)}", t1 - t0
    a, b = sorted(srows, key=key), sorted(drows, key=key)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[:2]}", t1 - t0
    return True, f"{len(srows)} rows", t1 - t0


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    ok_all = True
    for name in names or list(qs):
        if name not in sqls:
            t0 = time.time()
            try:
                n = qs[name](spark, sf).count()
                print(f"ROWS  {name}: {n} rows ({time.time()-t0:.1f}s)", flush=True)
            except Exception as e:  # noqa: BLE001
                ok_all = False
                print(f"ERROR {name}: {type(e).__name__}: {str(e)[:300]}", flush=True)
            continue
        try:
            ok, msg, dt = compare(name, qs[name](spark, sf), con, sqls[name])
        except Exception as e:  # noqa: BLE001
            ok, msg, dt = False, f"{type(e).__name__}: {str(e)[:400]}", 0
        ok_all &= ok
        print(f"{'PASS' if ok else 'FAIL'}  {name}: {msg} ({dt:.1f}s)", flush=True)
    spark.stop()
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
