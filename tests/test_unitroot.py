"""Unit-root tests against plain least squares and plain sums."""

import math

import numpy as np
import pytest

from shelfcast.operators.unitroot import KPSS_CRITICAL, KPSS_LEVELS, LARGE_P, SMALL_P, TAU_STAR, unit_root_tests


def adf(x):
    n = len(x)
    if n < 10 or np.ptp(x) == 0:
        return None
    most = min(math.ceil(12 * (n / 100) ** 0.25), n // 2 - 2)
    d = np.diff(x)

    def fit(lags, skip):  # the changes from `skip` on
        cols = [np.ones(len(d) - skip), x[skip:-1], *(d[skip - k : len(d) - k] for k in range(1, lags + 1))]
        y, a = d[skip:], np.column_stack(cols)
        if np.linalg.matrix_rank(a / np.abs(a).max(axis=0).clip(1e-300)) < a.shape[1]:
            return None
        b = np.linalg.lstsq(a, y, rcond=None)[0]
        ssr = float(((y - a @ b) ** 2).sum())
        if len(y) <= a.shape[1] or ssr <= 1e-11 * (y @ y):
            return None
        return len(y) * (math.log(2 * math.pi * ssr / len(y)) + 1) + 2 * a.shape[1], b[1] / math.sqrt(ssr / (len(y) - a.shape[1]) * np.linalg.inv(a.T @ a)[1, 1])

    fits = [fit(k, most) for k in range(most + 1)]
    if None in fits:
        return None
    lag = min(range(most + 1), key=lambda k: fits[k][0])
    stat = fit(lag, lag)[1]
    poly = SMALL_P if stat <= TAU_STAR else LARGE_P
    return stat, lag, 0.5 * math.erfc(-sum(c * stat**i for i, c in enumerate(poly)) / math.sqrt(2)) if -18.83 <= stat <= 2.74 else float(stat > 0)


def kpss(x):
    n = len(x)
    if n < 3 or np.ptp(x) == 0:
        return None
    e = x - x.mean()
    c = [sum(e[t] * e[t - k] for t in range(k, n)) for k in range(n)]
    pilot = math.floor(n ** (2 / 9))
    ratio = 2 * sum(k * c[k] for k in range(1, pilot + 1)) / (c[0] + 2 * sum(c[1 : pilot + 1]))
    lags = min(n - 1, math.floor(1.1447 * (ratio**2 * n) ** (1 / 3)))
    spread = (c[0] + 2 * sum(c[k] * (1 - k / (lags + 1)) for k in range(1, lags + 1))) / n
    stat = (np.cumsum(e) ** 2).sum() / n**2 / spread
    return stat, lags, float(np.interp(stat, KPSS_CRITICAL, KPSS_LEVELS))


SERIES = {
    "noise": np.random.default_rng(1).normal(50, 9, 160), "walk": np.random.default_rng(2).normal(0, 1, 200).cumsum() + 1e4,
    "trend": np.arange(120) * 3.0 + np.random.default_rng(3).normal(0, 5, 120), "weekly": np.sin(np.arange(90) * 2 * np.pi / 7) * 10 + np.random.default_rng(4).normal(0, 1, 90),
    "short": np.random.default_rng(5).normal(0, 1, 12), "tiny": np.arange(6.0), "one": np.array([4.0]), "constant": np.full(60, 3.0), "line": np.arange(80) * 2.0,
    "zeros": np.where(np.random.default_rng(6).random(150) < 0.8, 0.0, np.random.default_rng(7).normal(7, 2, 150)),
}


@pytest.fixture(scope="module")
def tested(spark):
    rows = [(name, i, float(v), 1) for name, x in SERIES.items() for i, v in enumerate(x)] + [("noise", 999, None, 1), ("none", 0, None, 1)]
    frame = spark.createDataFrame(rows, "s string, date int, v double, n_obs int").repartition(7)
    return {(r["s"], r["d"]): r for r in unit_root_tests(frame, "v", ["s"], diffs=(0, 1, 2)).collect()}


@pytest.mark.parametrize("name", SERIES)
@pytest.mark.parametrize("d", [0, 1, 2])
def test_against_plain_versions(tested, name, d):
    x = np.diff(SERIES[name], n=d)
    if not len(x):
        assert (name, d) not in tested
        return
    r, a, k = tested[name, d], adf(x), kpss(x)
    assert r["n_obs"] == len(x)
    if a is None:
        assert r["adf_stat"] is None and r["adf_lag"] is None and r["adf_pvalue"] is None and r["adf_reject"] is False
    else:
        assert r["adf_lag"] == a[1] and r["adf_stat"] == pytest.approx(a[0], rel=1e-6) and r["adf_pvalue"] == pytest.approx(a[2], abs=1e-7)
        assert r["adf_reject"] == (a[2] < 0.05)
    if k is None:
        assert r["kpss_stat"] is None and r["kpss_reject"] is False
    else:
        assert r["kpss_lags"] == k[1] and r["kpss_stat"] == pytest.approx(k[0], rel=1e-9) and r["kpss_pvalue"] == pytest.approx(k[2], abs=1e-9)
    names = {(True, False): "stationary", (False, True): "non-stationary", (True, True): "trend-stationary", (False, False): "difference-stationary"}
    assert r["verdict"] == names[r["adf_reject"], r["kpss_reject"]]


def test_series_without_values(tested):
    assert ("none", 0) not in tested


def test_one_series_without_keys(spark):
    x = SERIES["weekly"]
    r = unit_root_tests(spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "date int, v double"), "v", []).first()
    assert r["adf_stat"] == pytest.approx(adf(x)[0], rel=1e-6) and r["kpss_stat"] == pytest.approx(kpss(x)[0])
