"""Local stand-in for the driver's correctness gate.

Runs each registered query in Spark and its oracle SQL in DuckDB on the same
parquet tables, then compares row count, column names and values (columns
sorted by name, rows sorted). Floats are reported as exact or near (1e-9 rel).

usage: python tools/check.py [sf_dir] [key-substring ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

sys.path.insert(0, ".")

from shelfcast.registry import load_all  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v, exact: bool):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if exact else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v) if exact else float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, exact) for x in v)
    return v


def rows_of(cols, rows, exact):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(norm(r[i], exact) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 and "/" in sys.argv[1] else "/root/testdata/sf0.01"
    pats = [a for a in sys.argv[1:] if "/" not in a]
    reg = load_all()
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for key, e in reg.items():
        if pats and not any(p in key for p in pats):
            continue
        t0 = time.time()
        try:
            sdf = e.fn(spark, sf)
            scols = sdf.columns
            srows = [tuple(r) for r in sdf.collect()]
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {key}: spark error {type(ex).__name__}: {str(ex)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if e.sql is None:
            print(f"ROWS {key}: {len(srows)} rows ({ts:.1f}s) [no oracle]")
            continue
        try:
            res = con.execute(e.sql)
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as ex:  # noqa: BLE001
            print(f"FAIL {key}: duckdb error {str(ex)[:400]}")
            bad += 1
            continue
        if sorted(scols) != sorted(dcols):
            print(f"FAIL {key}: columns spark={scols} duck={dcols}")
            bad += 1
            continue
        if len(srows) != len(drows):
            print(f"FAIL {key}: rows spark={len(srows)} duck={len(drows)}")
            bad += 1
            continue
        if rows_of(scols, srows, True) == rows_of(dcols, drows, True):
            print(f"OK   {key}: {len(srows)} rows ({ts:.1f}s)")
            continue
        a, b = rows_of(scols, srows, False), rows_of(dcols, drows, False)
        if a == b:
            ea, eb = rows_of(scols, srows, True), rows_of(dcols, drows, True)
            ex = [(x, y) for x, y in zip(ea, eb) if x != y]
            print(f"NEAR {key}: {len(srows)} rows, {len(ex)} differ in last bits ({ts:.1f}s) e.g. {ex[0] if ex else ''}")
            bad += 1
            continue
        diffs = [(x, y) for x, y in zip(a, b) if x != y][:3]
        print(f"FAIL {key}: values differ; cols={sorted(scols)}")
        for x, y in diffs:
            print("   spark:", x)
            print("   duck :", y)
        bad += 1
    print(f"done, {bad} problems")


if __name__ == "__main__":
    main()
