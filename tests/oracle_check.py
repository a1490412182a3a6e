"""Run registered queries against their DuckDB oracle and compare results.

Usage: python tests/oracle_check.py [sf_dir] [name ...]

Compares row count, column names and the multiset of rows (columns sorted
by name). Floats are compared exactly and, separately, at 9 significant
digits so that last-bit differences are visible but distinguishable.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v, digits=None):
    if v is None:
        return None
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if digits:
            return float(f"{v:.{digits}g}")
        return v
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def _rows(cols, rows, digits=None):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name, query, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = query(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    s_cols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    out = {"name": name, "spark_rows": len(s_rows), "oracle_rows": len(d_rows),
           "spark_sec": round(t1 - t0, 2)}
    out["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not out["cols_match"]:
        out["spark_cols"] = sorted(s_cols)
        out["oracle_cols"] = sorted(d_cols)
        out["ok"] = False
        return out
    out["exact"] = _rows(s_cols, s_rows) == _rows(d_cols, d_rows)
    a, b = _rows(s_cols, s_rows, 9), _rows(d_cols, d_rows, 9)
    out["approx"] = a == b
    if not out["approx"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [x for x in a if x not in sb][:3]
        out["only_oracle"] = [x for x in b if x not in sa][:3]
    out["ok"] = out["approx"] and len(s_rows) == len(d_rows)
    return out


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    import __spark_entry__ as E
    from clickflow.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in (names or list(qs)):
        if n not in sqls:
            df = qs[n](spark, sf_dir)
            print({"name": n, "rows_only": df.count()})
            continue
        try:
            r = compare(spark, n, qs[n], sqls[n], sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        bad += 0 if r.get("ok") else 1
        print(r, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
