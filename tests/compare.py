"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str):
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{sf_dir}/{f}'")
    return con


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v + 0.0:.6f}"
    if isinstance(v, bool) or v is None:
        return str(v)
    if isinstance(v, int):
        return f"{float(v):.6f}"
    if type(v).__name__ == "Decimal":
        return f"{float(v):.6f}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(plain(x) for x in v) + "]"
    return str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got[1]), None
    cur = con.execute(sql)
    want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return len(got[1]), f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return len(got[1]), f"{len(got[1])} rows, SQL has {len(want[1])}"
    bad = [(a, b) for a, b in zip(*(got[1], want[1])) if a != b]
    return len(got[1]), f"{len(bad)} rows differ, e.g. {bad[0]}" if bad else None


def main(sf_dir, names, forced=False):
    from cohortspark.queries import ORACLES, QUERIES
    from cohortspark.session import local_session
    from cohortspark.operators import grouped

    if forced:  # cut groups however small they are
        grouped.TARGET_ROWS = int(forced)
    spark = local_session(8, 8)
    con = connect(sf_dir)
    failed = 0
    for name, fn in QUERIES.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, name, fn, ORACLES.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            n, problem = -1, f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        kind = "rows" if name not in ORACLES else "sql"
        print(f"{'BAD ' if problem else 'ok  '} {name:28s} {kind:4s} {n:8d} {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    args = sys.argv[1:]
    forced = int(args.pop(0).split("=")[1]) if args and args[0].startswith("--cut=") else 0
    main(args[0] if args else "/root/testdata/sf0.01", args[1:], forced)
