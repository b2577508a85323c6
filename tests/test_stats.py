import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfcast.functions import stats as st
from shelfcast.functions.numeric import chi2_sf, exact_avg, normal_sf
from shelfcast.operators.series import pacf_from_acf
from shelfcast.operators.unitroot import unit_root_tests


def test_chi2_and_normal_tails(spark):
    # closed forms: dof 2 is exp(-x/2), dof 1 the normal tail, dof 4 exp(-x/2) * (1 + x/2)
    x = [0.0, 0.1, 3.841458820694124, 9.487729036781154, 30.0, 80.0]
    rows = spark.createDataFrame([(v,) for v in x], "x double").select("x", *(chi2_sf(F.col("x"), F.lit(k)).alias(f"k{k}") for k in (1, 2, 3, 4))).collect()
    for r in rows:
        assert r["k2"] == pytest.approx(np.exp(-r["x"] / 2), rel=1e-12)
        assert r["k4"] == pytest.approx(np.exp(-r["x"] / 2) * (1 + r["x"] / 2), rel=1e-12)
        one = 2 * st.norm_sf(r["x"] ** 0.5)
        assert r["k1"] == pytest.approx(one, rel=1e-9)
        assert r["k3"] == pytest.approx(one + (2 * r["x"] / np.pi) ** 0.5 * np.exp(-r["x"] / 2), rel=1e-9)
    z = spark.createDataFrame([(v,) for v in (-3.0, -0.5, 0.0, 1.0, 1.96, 4.3, 8.0)], "z double").select("z", normal_sf(F.col("z")).alias("p")).collect()
    assert all(r["p"] == pytest.approx(st.norm_sf(r["z"]), rel=1e-9) for r in z)


def test_pacf_of_an_ar1_and_of_a_constant(spark):
    acf = spark.createDataFrame([("a", k, 0.5**k) for k in range(4)] + [("b", k, None) for k in range(4)], "s string, lag int, acf double")
    rows = sorted(pacf_from_acf(acf, ["s"]).collect())
    assert [r["pacf"] for r in rows[:4]] == pytest.approx([1, 0.5, 0, 0]) and [r["pacf"] for r in rows[4:]] == [1.0, None, None, None]


def brute_mann_whitney(a, b):
    """Two-sided exact p: every way to choose the first group's ranks."""
    ranks = {v: i + 1 for i, v in enumerate(sorted(a + b))}
    u = lambda r: sum(r) - len(a) * (len(a) + 1) / 2
    seen = u([ranks[v] for v in a])
    seen = max(seen, len(a) * len(b) - seen)
    all_u = [u(c) for c in itertools.combinations(range(1, len(a) + len(b) + 1), len(a))]
    return min(1.0, 2 * sum(x >= seen for x in all_u) / len(all_u))


@pytest.mark.parametrize("n1,n2", [(3, 3), (3, 13), (1, 9), (8, 4), (2, 12)])
def test_mann_whitney_exact_if_either_group_is_small(n1, n2):
    rng = np.random.default_rng(n1 * 100 + n2)
    for _ in range(4):
        v = rng.permutation(n1 + n2).tolist()
        a, b = v[:n1], v[n1:]
        u = sum(x > y for x in a for y in b)
        assert st.mann_whitney_p(u, n1, n2, 0) == pytest.approx(brute_mann_whitney(a, b))


def test_mann_whitney_with_ties():
    # light ties: the variance of the ranks over all arrangements, computed directly
    for a, b in (([1, 2, 2, 3, 9, 9, 9, 10, 11], [0, 2, 4, 5, 6, 7, 8, 9, 12]), ([1] * 9 + [2], [1] * 5 + [2] * 5), ([1, 1], [1, 1, 1])):
        both = a + b
        ties = sum(both.count(v) ** 3 - both.count(v) for v in set(both))
        u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
        n1, n2, n = len(a), len(b), len(both)
        order = np.array([np.mean([i + 1 for i, w in enumerate(sorted(both)) if w == v]) for v in both])
        s = (n1 * n2 / (n * (n - 1)) * ((order - order.mean()) ** 2).sum()) ** 0.5
        want = 1.0 if s == 0 else min(1.0, 2 * st.norm_sf((max(u, n1 * n2 - u) - n1 * n2 / 2 - 0.5) / s))
        assert st.mann_whitney_p(u, n1, n2, ties) == pytest.approx(want)


def test_unit_roots_of_series_without_residual(spark):
    once = [0.0] * 500
    once[3] = 5.0
    series = {"line": [float(k) for k in range(300)], "flip": [float(k % 2) for k in range(300)], "once": once, "week": [float(k % 7) for k in range(350)], "same": [1.0] * 50, "short": [1.0, 2.0], "noise": np.random.default_rng(1).normal(size=300).tolist()}
    frame = spark.createDataFrame([(s, k, v) for s, vs in series.items() for k, v in enumerate(vs)], "s string, date int, x double")
    rows = {(r["s"], r["d"]): r for r in unit_root_tests(frame, "x", ["s"], diffs=(0, 1)).collect()}
    assert len(rows) == 2 * len(series)
    assert all(rows[s, 0]["adf_stat"] is None and rows[s, 0]["adf_reject"] is False for s in ("line", "flip", "week", "same", "short"))
    assert rows["noise", 0]["adf_reject"] and rows["noise", 0]["verdict"] == "stationary"
    only = unit_root_tests(frame, "x", ["s"], tests=("kpss",)).where("s = 'noise'").first()
    assert only["adf_reject"] is None and only["kpss_stat"] == pytest.approx(rows["noise", 0]["kpss_stat"])


def test_means_of_large_values(spark):
    r = spark.createDataFrame([(1.2e13,), (1.3e13,), (0.1,)], "x double").agg(exact_avg("x", 4).alias("m")).first()
    assert r["m"] == 8333333333333.3667
