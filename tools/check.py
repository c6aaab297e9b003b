"""Run registered queries against their check SQL and report differences.

usage: python tools/check.py [--sf DIR] [key or prefix* ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import glob
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb

from lampyris.catalog import load_all
from lampyris.session import build_session


def _norm(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (dt.date,)):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return f"DEC {v}"
    if isinstance(v, float):
        return repr(v + 0.0)
    return repr(v)


def table_of(arrow):
    names = sorted(arrow.column_names)
    cols = [arrow.column(n).to_pylist() for n in names]
    return names, sorted(tuple(_norm(c[i]) for c in cols) for i in range(arrow.num_rows))


def kinds(arrow):
    def kind(t):
        s = str(t)
        if s.startswith("timestamp"):
            return "timestamp"
        return {"large_string": "string"}.get(s, s)

    return {n: kind(arrow.schema.field(n).type) for n in arrow.column_names}


def connect(sf: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def compare(spark, con, entry, sf):
    """(status, detail, spark seconds)"""
    t0 = time.time()
    got = entry.run(spark, sf).toArrow()
    secs = time.time() - t0
    if entry.sql is None:
        return "rows", f"{got.num_rows} rows", secs
    want = con.execute(entry.sql).to_arrow_table()
    gn, gr = table_of(got)
    wn, wr = table_of(want)
    if gn != wn:
        return "FAIL", f"columns {gn} vs {wn}", secs
    if gr != wr:
        diff = [(a, b) for a, b in zip(gr, wr) if a != b][:2]
        return "FAIL", f"rows {len(gr)} vs {len(wr)}; {diff}", secs
    gk, wk = kinds(got), kinds(want)
    odd = {n: (gk[n], wk[n]) for n in gn if gk[n] != wk[n]}
    return "ok" if not odd else "type", f"{len(gr)} rows {odd or ''}", secs


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    args = ap.parse_args()
    registry = load_all()
    spark = build_session("check", cores=8, spark__sql__shuffle__partitions="8")
    con = connect(args.sf)

    def wanted(key):
        return not args.keys or any(key == k or (k.endswith("*") and key.startswith(k[:-1])) for k in args.keys)

    bad = 0
    for key, entry in registry.items():
        if not wanted(key):
            continue
        try:
            status, detail, secs = compare(spark, con, entry, args.sf)
        except Exception as exc:  # noqa: BLE001 - report and go on
            status, detail, secs = "ERROR", f"{type(exc).__name__}: {str(exc)[:700]}", 0.0
        bad += status in ("FAIL", "ERROR")
        print(f"{status:5} {secs:6.2f}s {key:32} {detail[:900]}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
