"""Every query with oracle SQL agrees with DuckDB on the sf0.001 tables (floats to 9 significant digits)."""

import datetime as dt
import decimal
import math

import pytest

from shelfcast.registry import load_all

from conftest import SF

REG = load_all()
KEYS = sorted(k for k, e in REG.items() if e.sql is not None)


def _norm(v):
    if v is None:
        return None
    if isinstance(v, (float, decimal.Decimal)):
        v = float(v)
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dt.datetime):
        return v.date().isoformat() if v.time() == dt.time(0) else v.isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


@pytest.mark.parametrize("key", KEYS)
def test_matches_duckdb(spark, duck, key):
    e = REG[key]
    sdf = e.fn(spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(e.sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows) == _rows(dcols, drows)
