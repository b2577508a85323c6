"""Rolling-origin evaluation: every model against a plain version, the reports against DuckDB on stored predictions."""

import datetime as dt
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.catalog.backtests import comparison_sql
from shelfcast.catalog.sqlparts import metrics_sql
from shelfcast.operators import backtest as bt
from shelfcast.operators import models as mdl
from shelfcast.session import materialize

KEYS = ["store_nbr", "family"]
LAST = dt.date(2020, 6, 1)
STARTS = bt.origins(LAST, 3, 10)
H = 5


@pytest.fixture(scope="module")
def panel(spark):
    rows = []
    for store, family, days, skip in ((1, "a", 400, 0), (1, "b", 400, 9), (2, "a", 14, 0), (2, "b", 60, 0)):
        for k in range(days):
            day = LAST + dt.timedelta(days=H + 2 - k)
            if not skip or k % skip:
                rows.append((store, family, day, float(20 + 5 * (day.toordinal() % 7) + (k * 7919 % 11) + store)))
    rows.append((3, "c", LAST, 4.0))  # nothing before any origin
    return materialize(spark.createDataFrame(rows, "store_nbr int, family string, date date, sales double"), "panel")


@pytest.fixture(scope="module")
def series(panel):
    out = {}
    for r in panel.collect():
        out.setdefault((r["store_nbr"], r["family"]), {})[r["date"]] = r["sales"]
    return out


def test_origins():
    assert STARTS == [LAST - dt.timedelta(days=20), LAST - dt.timedelta(days=10), LAST] and bt.origins(LAST, 1, 7) == [LAST]


def test_models_without_a_fit(panel, series):
    found = {(r["store_nbr"], r["family"], r["origin"], r["date"], r["model"]): (r["actual"], r["predicted"]) for r in bt.simple_forecasts(panel, KEYS, STARTS, H).collect()}
    expected = {}
    for key, days in series.items():
        for o in STARTS:
            past = [days[o - dt.timedelta(days=k)] for k in range(1, 29) if o - dt.timedelta(days=k) in days]
            for h in range(H):
                day = o + dt.timedelta(days=h)
                if day in days:
                    expected[(*key, o, day, "mean")] = (days[day], pytest.approx(np.mean(past)) if past else None)
                    expected[(*key, o, day, "seasonal_naive")] = (days[day], days.get(day - dt.timedelta(days=7)))
    assert found == expected
    assert found[3, "c", LAST, LAST, "mean"] == (4.0, None)
    exact = bt.simple_forecasts(panel, KEYS, STARTS, H, decimals=4).where("model = 'mean'").collect()
    assert all(r["predicted"] == pytest.approx(found[r["store_nbr"], r["family"], r["origin"], r["date"], "mean"][1], abs=1e-6) for r in exact if r["predicted"] is not None)


def test_arima_per_origin(panel, series):
    rows = bt.arima_forecasts(panel, KEYS, STARTS, H).collect()
    assert len(rows) == sum(o <= d < o + dt.timedelta(days=H) for days in series.values() for d in days for o in STARTS)
    details = {}
    for r in rows:
        days = series[r["store_nbr"], r["family"]]
        past = np.array([days[d] for d in sorted(days) if d < r["origin"]])
        forecast, order = mdl.arima_forecast(np.log1p(past), H)
        details.setdefault((r["store_nbr"], r["family"]), set()).add(order)
        assert r["detail"] == order and r["actual"] == days[r["date"]]
        if forecast is None:
            assert r["predicted"] is None
        else:
            assert r["predicted"] == pytest.approx(max(math.expm1(forecast[(r["date"] - r["origin"]).days]), 0.0))
    assert details[1, "a"] == {"SARIMA(1,1,1)x(1,1,1,7)"} and "FAILED" in details[2, "a"] and details[3, "c"] == {"FAILED"}


def test_boosters_see_only_what_lies_before_the_origin(panel):
    day = F.datediff("date", F.lit(dt.date(2019, 1, 1)))
    table = panel.withColumns({"sales_log": F.log1p("sales"), "dow": (day % 7).cast("double"), "short_lag": F.col("sales") + 0.0, "key": F.concat_ws("_", "store_nbr", "family"), "code": F.lit(0.0)})
    args = {"features": ["dow", "short_lag", "code"], "settings": [({"minInstancesPerNode": 1, "maxDepth": 3}, 1.0)], "rounds": 2, "lags": {"short_lag": 2}, "encoded": ("key", "code")}
    found = lambda t: {(r["store_nbr"], r["family"], r["date"]): r["predicted"] for r in bt.booster_forecasts(t, KEYS, [LAST], H, **args).collect()}
    a = found(table)
    # other values from the origin on change the forecasts of its first two days only, through the lag known there
    b = found(table.withColumns({c: F.when(F.col("date") >= F.lit(LAST), F.col(c) * 50 + 7).otherwise(F.col(c)) for c in ("sales", "sales_log", "short_lag")}))
    later = {k for k in a if k[2] >= LAST + dt.timedelta(days=2)}
    assert later and all(a[k] == b[k] for k in later) and a.keys() == b.keys()


def test_reports_agree_with_sql_on_stored_predictions(spark, panel, series):
    models = ["arima", "seasonal_naive", "mean"]
    pred = materialize(bt.arima_forecasts(panel, KEYS, STARTS, H).unionByName(bt.simple_forecasts(panel, KEYS, STARTS, H)), "predictions")
    days = materialize(bt.history_days(panel, KEYS, STARTS), "days")
    compared = bt.comparison(pred, days, KEYS, models)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pr AS SELECT * FROM read_parquet('{pred._scratch.removeprefix('file:')}/*.parquet')")
    con.execute(f"CREATE VIEW td AS SELECT * FROM read_parquet('{days._scratch.removeprefix('file:')}/*.parquet')")
    cols = compared.columns
    expected = con.execute("WITH " + comparison_sql(models) + "SELECT " + ", ".join(f'"{c}"' for c in cols) + " FROM cm").fetchall()
    key = lambda r: tuple(map(str, r[:3]))
    rows = sorted((tuple(r) for r in compared.collect()), key=key)
    assert len(rows) == sum(any(o <= d < o + dt.timedelta(days=H) for d in own) for own in series.values() for o in STARTS)
    for r, e in zip(rows, sorted(expected, key=key), strict=True):
        assert all(x == (pytest.approx(y, abs=2e-6) if isinstance(y, float) else y) for x, y in zip(r, e, strict=True))
    for by in ("origin", "date"):  # error tables of any model come from its stored predictions
        table = sorted(map(tuple, bt.scores(pred, [by]).select(by, "model", "rmsle", "rmse", "mae", "n", "n_rows", "failed").collect()), key=str)
        sql = sorted(con.execute(f"SELECT {by}, model, rmsle, rmse, mae, n, n_rows, failed FROM (SELECT {by}, model, {metrics_sql('actual', 'predicted')}, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE predicted IS NULL) AS failed FROM pr GROUP BY {by}, model)").fetchall(), key=str)
        for r, e in zip(table, sql, strict=True):
            assert all(x == (pytest.approx(y, abs=2e-6) if isinstance(y, float) else y) for x, y in zip(r, e, strict=True))

    alone = next(r for r in compared.collect() if r["family"] == "c")
    assert (alone["train_days"], alone["val_days"], alone["best"], alone["failed_arima"], alone["rmsle_arima"]) == (0, 1, None, 1, None)

    wins = {r["model"]: r for r in bt.wins(compared, models).collect()}
    best = [r["best"] for r in compared.collect()]
    assert {m: wins[m]["wins"] for m in models} == {m: best.count(m) for m in models} and wins["arima"]["failed"] == pred.where("model = 'arima' and predicted is null").count()

    s = {(r["origin"], r["model"]): r for r in bt.scores(pred, ["origin"]).collect()}
    for r in bt.gaps(pred, "seasonal_naive", ["arima", "mean"]).collect():
        a, b = s[r["origin"], "seasonal_naive"], s[r["origin"], r["model"]]
        assert (r["rmsle_base"], r["rmsle"]) == (a["rmsle"], b["rmsle"]) and r["mae_gap"] == pytest.approx(b["mae"] - a["mae"], abs=1e-6)
    assert bt.scores(pred.limit(0), ["origin"]).count() == bt.comparison(pred.limit(0), days, KEYS, models).count() == 0
