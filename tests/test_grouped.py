"""Operators without an SQL oracle, checked against brute force on small fixtures."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators import models as mdl
from shelfcast.operators import series as ts
from shelfcast.operators.profile import exact_quantiles
from shelfcast.operators.unitroot import unit_root_tests


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(1)
    vals = np.round(rng.gamma(2.0, 50.0, size=997), 2)
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    q = exact_quantiles(df, "x", [0.25, 0.5, 0.99]).collect()[0]
    assert q["q25"] == pytest.approx(np.percentile(vals, 25))
    assert q["q50"] == pytest.approx(np.percentile(vals, 50))
    assert q["q99"] == pytest.approx(np.percentile(vals, 99))


def test_pacf_matches_yule_walker(spark):
    rng = np.random.default_rng(2)
    e = rng.normal(size=400)
    x = np.zeros(400)
    for t in range(2, 400):
        x[t] = 0.6 * x[t - 1] - 0.2 * x[t - 2] + e[t]
    pdf = pd.DataFrame({"date": pd.date_range("2000-01-01", periods=400).date, "v": x})
    df = spark.createDataFrame(pdf)
    a = ts.acf(df, "v", 5)
    p = {r.lag: r.pacf for r in ts.pacf_from_acf(a).collect()}
    r = np.array([r.acf for r in a.orderBy("lag").collect()])
    for k in range(1, 6):  # brute force: last coefficient of the order-k Yule-Walker solution
        R = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        phi = np.linalg.solve(R, r[1:k + 1])
        assert p[k] == pytest.approx(phi[-1], abs=1e-9)


def test_arima_per_series_shapes_and_fallback(spark):
    days = pd.date_range("2000-01-01", periods=200)
    rows = []
    for s in (1, 2):
        base = 50 + 10 * np.sin(np.arange(200) * 2 * np.pi / 7) * s
        rows += [(d.date(), s, "G", float(v)) for d, v in zip(days, base)]
    rows += [(days[i].date(), 3, "G", 1.0) for i in range(5)]  # too short: falls back to FAILED
    df = spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")
    out = mdl.arima_per_series(df, ["store_nbr", "family"], 15).toPandas()
    assert len(out) == 45
    good = out[out.store_nbr != 3]
    assert good.pred.notna().all() and (good.pred >= 0).all()
    assert set(out[out.store_nbr == 3].model_order) == {"FAILED"}


def test_unit_root_per_series_groups(spark):
    rng = np.random.default_rng(3)
    days = pd.date_range("2000-01-01", periods=300).date
    pdf = pd.concat([pd.DataFrame({"date": days, "k": 1, "v": rng.normal(size=300)}),
                     pd.DataFrame({"date": days, "k": 2, "v": np.cumsum(rng.normal(size=300))})])
    out = {r.k: r for r in unit_root_tests(spark.createDataFrame(pdf), "v", ["k"]).collect()}
    assert out[1].verdict == "stationary"
    assert out[2].adf_reject is False and out[2].kpss_reject is True
