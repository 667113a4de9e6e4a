"""Spark query vs DuckDB oracle: row count, column names, order-insensitive values.

Usage: python -m tests.parity [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canon(v):
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        return f"{round(float(v), 6):.6f}"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    return str(v)


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(canon(r[i]) for i in order) for r in rows)


def compare(spark, con, key, fn, sql, sf_dir):
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    s_cols = df.columns
    ok_cols = sorted(s_cols) == sorted(d_cols)
    ok_rows = len(s_rows) == len(d_rows)
    ok_vals = ok_cols and bag(s_cols, s_rows) == bag(d_cols, d_rows)
    return dict(key=key, cols=ok_cols, rows=ok_rows, values=ok_vals, n_spark=len(s_rows), n_duck=len(d_rows),
                spark_s=round(t1 - t0, 2), duck_s=round(t2 - t1, 2), s_cols=s_cols, d_cols=d_cols,
                s_sample=sorted(bag(s_cols, s_rows) - bag(d_cols, d_rows))[:3] if ok_cols else None,
                d_sample=sorted(bag(d_cols, d_rows) - bag(s_cols, s_rows))[:3] if ok_cols else None)


def main(argv):
    import __spark_entry__ as E
    from tillroll.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    keys = argv[1:] or list(E.oracle_sql())
    spark = get_session(shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys:
        if k not in sqls:
            print(f"{k:14s} no oracle")
            continue
        try:
            r = compare(spark, con, k, qs[k], sqls[k], sf_dir)
        except Exception as e:  # report and go on
            bad += 1
            print(f"{k:14s} ERROR {type(e).__name__}: {str(e)[:400]}")
            continue
        ok = r["cols"] and r["rows"] and r["values"]
        bad += not ok
        print(f"{k:14s} {'OK ' if ok else 'BAD'} rows {r['n_spark']}/{r['n_duck']} spark {r['spark_s']}s duck {r['duck_s']}s")
        if not ok:
            print("   cols", r["s_cols"], r["d_cols"])
            print("   spark-only", r["s_sample"])
            print("   duck-only ", r["d_sample"])
    print("mismatches:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
