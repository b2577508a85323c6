"""Time-series, ranking and hypothesis-test queries (TS-01..TS-14, W-14, R-08, H-01, H-02, T-05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions import stats as st
from shelfcast.functions.numeric import EPS, chi2_sf, exact_sum
from shelfcast.operators import series as ts
from shelfcast.operators.quantiles import summarize
from shelfcast.operators.ranks import average_rank
from shelfcast.operators.unitroot import unit_root_tests
from shelfcast.operators.joins import anti_join
from shelfcast.operators.panel import complete_panel, ffill_bfill
from shelfcast.registry import register
from shelfcast.session import ship_package
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import DEFAULT_SPLIT, PanelSpec

XSUM = "CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"
REGULAR_SQL = f"""(SELECT date, COALESCE(total, last_value(total IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS total
  FROM (SELECT CAST(g.d AS DATE) AS date, r.total FROM (SELECT MIN(date) d0, MAX(date) d1 FROM sales_raw) b
        CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
        LEFT JOIN (SELECT date, {XSUM.format(x='sales')} AS total FROM sales_raw GROUP BY date) r ON r.date = CAST(g.d AS DATE)))"""


def daily_regular(spark, sf):
    """Daily total with enforced daily frequency and forward fill (TS-01)."""
    d = fx.sales_raw(spark, sf).groupBy("date").agg(exact_sum("sales").alias("total"))
    g = complete_panel(d, PanelSpec(keys=(), target="total"), flag_col=None)
    return ffill_bfill(g, ["total"]).select("date", "total")


register("daily_regular", with_views(f"SELECT * FROM {REGULAR_SQL}"), ids="TS-01, W-09")(daily_regular)


def _decomp_sql(period, model, digits):
    h = period // 2
    det = "total - trend" if model == "additive" else "total / trend"
    seas = "pm.pm - nm.nm" if model == "additive" else "pm.pm / nm.nm"
    resid = f"total - trend - ({seas})" if model == "additive" else f"total / (trend * ({seas}))"
    return with_views(f"""
WITH d AS {REGULAR_SQL},
t AS (SELECT date, total, CASE WHEN count(total) OVER w = {period} THEN avg(total) OVER w END AS trend,
      (row_number() OVER (ORDER BY date) - 1) % {period} AS ph FROM d
      WINDOW w AS (ORDER BY date ROWS BETWEEN {h} PRECEDING AND {h} FOLLOWING)),
pm AS (SELECT ph, avg({det}) AS pm FROM t GROUP BY ph),
nm AS (SELECT avg(pm) AS nm FROM pm)
SELECT t.date, t.total, round(trend, {digits}) AS trend, round({seas}, {digits}) AS seasonal, round({resid}, {digits}) AS resid
FROM t JOIN pm ON pm.ph = t.ph, nm""")


def _decomp(spark, sf, period, model, digits):
    d = ts.decompose(daily_regular(spark, sf), "total", period, model)
    return d.select("date", "total", *[F.round(c, digits).alias(c) for c in ("trend", "seasonal", "resid")])


@register("decompose_additive", _decomp_sql(7, "additive", 4), ids="TS-02")
def decompose_additive(spark, sf):
    return _decomp(spark, sf, 7, "additive", 4)


@register("decompose_multiplicative", _decomp_sql(365, "multiplicative", 6), ids="TS-02")
def decompose_multiplicative(spark, sf):
    return _decomp(spark, sf, 365, "multiplicative", 6)


@register("decomp_strength", with_views(f"""
WITH d AS {REGULAR_SQL},
t AS (SELECT date, total, CASE WHEN count(total) OVER w = 7 THEN avg(total) OVER w END AS trend,
      (row_number() OVER (ORDER BY date) - 1) % 7 AS ph FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
pm AS (SELECT ph, avg(total - trend) AS pm FROM t GROUP BY ph), nm AS (SELECT avg(pm) AS nm FROM pm),
x AS (SELECT trend, pm.pm - nm.nm AS seasonal, total - trend - (pm.pm - nm.nm) AS resid FROM t JOIN pm ON pm.ph = t.ph, nm
      WHERE trend IS NOT NULL)
SELECT round(greatest(0.0, 1 - var_pop(resid) / var_pop(trend + resid)), 6) AS trend_strength,
       round(greatest(0.0, 1 - var_pop(resid) / var_pop(seasonal + resid)), 6) AS seasonal_strength FROM x"""), ids="TS-07")
def decomp_strength(spark, sf):
    d = ts.decompose(daily_regular(spark, sf), "total", 7, "additive")
    s = ts.decomposition_strength(d)
    return s.select(F.round("trend_strength", 6).alias("trend_strength"), F.round("seasonal_strength", 6).alias("seasonal_strength"))


_NL = 60


@register("acf", with_views(f"""
WITH d AS {REGULAR_SQL},
c AS (SELECT row_number() OVER (ORDER BY date) AS i, total - avg(total) OVER () AS c FROM d),
den AS (SELECT SUM(c * c) AS s, COUNT(*) AS n FROM c),
a AS (SELECT r.k AS lag, SUM(x.c * y.c) / den.s AS acf, den.n AS n
      FROM range(0, {_NL + 1}) r(k) JOIN c x ON TRUE JOIN c y ON y.i = x.i - r.k CROSS JOIN den GROUP BY r.k, den.s, den.n)
SELECT lag, round(acf, 6) AS acf, round(CASE WHEN lag = 0 THEN 0.0 ELSE 1.959963984540054 * sqrt((1 + 2 * COALESCE(SUM(
  CASE WHEN lag > 0 THEN acf * acf ELSE 0.0 END) OVER (ORDER BY lag ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0)) / n) END, 6) AS band
FROM a"""), ids="TS-05")
def acf_q(spark, sf):
    a = ts.acf(daily_regular(spark, sf), "total", _NL)
    return a.select("lag", F.round("acf", 6).alias("acf"), F.round("band", 6).alias("band"))


@register("pacf", with_views(f"""
WITH RECURSIVE p AS (SELECT store_nbr, family, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date) AS i,
    sales - avg(sales) OVER (PARTITION BY store_nbr, family) AS c FROM sales_panel),
k AS (SELECT store_nbr, family, SUM(c * c) AS p0 FROM p GROUP BY 1, 2),
l AS (SELECT x.store_nbr, x.family, r.k, SUM(x.c * y.c) AS pk FROM range(1, {_NL + 1}) r(k) JOIN p x ON TRUE
    JOIN p y ON y.store_nbr = x.store_nbr AND y.family = x.family AND y.i = x.i - r.k GROUP BY 1, 2, 3),
a AS (SELECT l.store_nbr, l.family, list(pk / NULLIF(p0, 0) ORDER BY l.k) AS r FROM l JOIN k ON k.store_nbr = l.store_nbr AND k.family = l.family GROUP BY 1, 2),
s AS (SELECT store_nbr, family, r, 0 AS lag, CAST([] AS DOUBLE[]) AS phi, 1.0::DOUBLE AS v, 1.0::DOUBLE AS pacf FROM a
  UNION ALL
  SELECT store_nbr, family, r, lag + 1, list_append(list_transform(range(1, lag + 1), lambda j: phi[j] - b * phi[lag + 1 - j]), b), v * (1 - b * b), b
  FROM (SELECT *, (r[lag + 1] - COALESCE(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * r[lag + 1 - j])), 0)) / NULLIF(v, 0) AS b FROM s WHERE lag < {_NL}))
SELECT store_nbr, family, CAST(lag AS INTEGER) AS lag, round(pacf, 6) AS pacf FROM s"""), ids="TS-06")
def pacf_q(spark, sf):
    keys = ["store_nbr", "family"]
    a = ts.acf(fx.sales_panel(spark, sf), "sales", _NL, keys)
    return ts.pacf_from_acf(a, keys).withColumn("pacf", F.round("pacf", 6))


SERIES = ["store_nbr", "family"]


@register("adf_per_series", None, ids="TS-08, TS-10")
def adf_per_series(spark, sf):
    return unit_root_tests(fx.sales_panel(spark, sf), "sales", SERIES, tests=("adf",)).select(
        *SERIES, "n_obs", "adf_stat", "adf_lag", "adf_pvalue", "adf_reject")


# bandwidth and weights from the lagged products of the centred values
KPSS_SQL = """
WITH s AS (SELECT store_nbr, family, COUNT(*) AS n, list(sales ORDER BY date) AS x, avg(sales) AS m FROM sales_panel WHERE sales IS NOT NULL GROUP BY 1, 2),
e AS (SELECT store_nbr, family, n, list_transform(x, lambda v: v - m) AS e FROM s),
p AS (SELECT *, list_transform(range(0, CAST(floor(power(n, 2.0 / 9)) AS INTEGER) + 1), lambda k: list_sum(list_transform(range(1, n - k + 1), lambda i: e[i] * e[i + k]))) AS c FROM e WHERE n >= 3),
b AS (SELECT *, c[1] + 2 * list_sum(c[2:]) AS s0, 2 * list_sum(list_transform(range(1, len(c)), lambda k: k * c[k + 1])) AS s1 FROM p WHERE c[1] > 0),
l AS (SELECT *, CAST(least(floor(1.1447 * power(power(s1 / s0, 2) * n, 1.0 / 3)), n - 1) AS INTEGER) AS lags FROM b),
v AS (SELECT *, (c[1] + 2 * COALESCE(list_sum(list_transform(range(1, lags + 1), lambda k: (1 - k / (lags + 1.0)) * list_sum(list_transform(range(1, n - k + 1), lambda i: e[i] * e[i + k])))), 0)) / n AS spread FROM l),
q AS (SELECT store_nbr, family, SUM(ps * ps) AS q FROM (SELECT store_nbr, family, SUM(sales - m) OVER (PARTITION BY store_nbr, family ORDER BY date) AS ps
      FROM sales_panel JOIN s USING (store_nbr, family) WHERE sales IS NOT NULL) GROUP BY 1, 2),
k AS (SELECT e.store_nbr, e.family, CAST(e.n AS INTEGER) AS n_obs, q.q / e.n / e.n / v.spread AS stat, v.lags FROM e JOIN q USING (store_nbr, family) LEFT JOIN v USING (store_nbr, family))
SELECT store_nbr, family, n_obs, round(stat, 6) AS kpss_stat, lags AS kpss_lags, round(pv, 6) AS kpss_pvalue, COALESCE(pv < 0.05, false) AS kpss_reject
FROM (SELECT *, CASE WHEN stat <= 0.347 THEN 0.1 WHEN stat <= 0.463 THEN 0.1 - (stat - 0.347) / 0.116 * 0.05 WHEN stat <= 0.574 THEN 0.05 - (stat - 0.463) / 0.111 * 0.025
  WHEN stat <= 0.739 THEN 0.025 - (stat - 0.574) / 0.165 * 0.015 WHEN stat IS NOT NULL THEN 0.01 END AS pv FROM k)"""


@register("kpss_per_series", with_views(KPSS_SQL), ids="TS-09")
def kpss_per_series(spark, sf):
    t = unit_root_tests(fx.sales_panel(spark, sf), "sales", SERIES, tests=("kpss",))
    return t.select(*SERIES, "n_obs", F.round("kpss_stat", 6).alias("kpss_stat"), "kpss_lags", F.round("kpss_pvalue", 6).alias("kpss_pvalue"), "kpss_reject")


@register("stationarity_verdict", None, ids="TS-10")
def stationarity_verdict(spark, sf):
    return unit_root_tests(fx.sales_panel(spark, sf), "sales", SERIES).select(*SERIES, "adf_reject", "kpss_reject", "verdict")


@register("recommend_d", None, ids="TS-11, W-12")
def recommend_d(spark, sf):
    """The smallest order of differencing, 0 to 2, at which both tests call a series stationary (null: none)."""
    tests = unit_root_tests(fx.sales_panel(spark, sf), "sales", SERIES, diffs=(0, 1, 2))
    ok = F.col("adf_reject") & ~F.col("kpss_reject")
    return tests.groupBy(*SERIES).agg(F.min(F.when(ok, F.col("d"))).alias("recommended_d"))


_TRAIN_END = DEFAULT_SPLIT.train[1]
_ACF_CUTOFF = dt.date(2000, 6, 1)  # fixed value: start of the recent window for the lag-7 autocorrelation
_V0, _V1 = DEFAULT_SPLIT.val

REPR_SQL = f"""
WITH tr AS (SELECT * FROM sales_panel WHERE date <= DATE '{_TRAIN_END}'),
st AS (SELECT store_nbr, family, avg(sales) AS mean, stddev_samp(sales) / (avg(sales) + 1e-9) AS cv,
   avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END) AS zero_ratio FROM tr GROUP BY 1, 2),
rc AS (SELECT store_nbr, family, sales, lag(sales, 7) OVER (PARTITION BY store_nbr, family ORDER BY date) AS l7
   FROM tr WHERE date >= DATE '{_ACF_CUTOFF}'),
ac AS (SELECT store_nbr, family, CASE WHEN COUNT(sales) > 14 AND stddev_pop(sales) > 0 THEN COALESCE(corr(sales, l7), 0.0)
   ELSE 0.0 END AS acf_lag7 FROM rc GROUP BY 1, 2),
sv AS (SELECT st.*, ac.acf_lag7 FROM st JOIN ac ON ac.store_nbr = st.store_nbr AND ac.family = st.family
   WHERE (st.store_nbr, st.family) IN (SELECT store_nbr, family FROM sales_panel WHERE date BETWEEN DATE '{_V0}' AND DATE '{_V1}')),
p1 AS (SELECT 1 AS pick, 'high_stable' AS pattern, store_nbr, family FROM sv WHERE cv <= (SELECT quantile_cont(cv, 0.5) FROM sv)
   ORDER BY mean DESC, store_nbr, family LIMIT 1),
p2 AS (SELECT 2 AS pick, 'low_sales' AS pattern, store_nbr, family FROM sv WHERE zero_ratio < 0.3 AND mean > 0
   AND (store_nbr, family) NOT IN (SELECT store_nbr, family FROM p1) ORDER BY mean ASC, store_nbr, family LIMIT 1),
c2 AS (SELECT store_nbr, family FROM p1 UNION ALL SELECT store_nbr, family FROM p2),
p3 AS (SELECT 3 AS pick, 'seasonality' AS pattern, store_nbr, family FROM sv WHERE (store_nbr, family) NOT IN (SELECT * FROM c2)
   ORDER BY acf_lag7 DESC, store_nbr, family LIMIT 1),
c3 AS (SELECT * FROM c2 UNION ALL SELECT store_nbr, family FROM p3),
p4 AS (SELECT 4 AS pick, 'many_zeros' AS pattern, store_nbr, family FROM sv WHERE zero_ratio > 0.3
   AND (store_nbr, family) NOT IN (SELECT * FROM c3) ORDER BY zero_ratio DESC, store_nbr, family LIMIT 1),
c4 AS (SELECT * FROM c3 UNION ALL SELECT store_nbr, family FROM p4),
p5 AS (SELECT 5 AS pick, 'high_volatility' AS pattern, store_nbr, family FROM sv WHERE (store_nbr, family) NOT IN (SELECT * FROM c4)
   ORDER BY cv DESC, store_nbr, family LIMIT 1),
representative AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3 UNION ALL SELECT * FROM p4 UNION ALL SELECT * FROM p5)
"""


def representative_df(spark, sf):
    keys = ["store_nbr", "family"]
    p = fx.sales_panel(spark, sf)
    tr = p.where(F.col("date") <= F.lit(_TRAIN_END))
    x = F.col("sales")
    stt = tr.groupBy(*keys).agg(F.avg(x).alias("mean"), (F.stddev_samp(x) / (F.avg(x) + F.lit(EPS))).alias("cv"),
                                F.avg((x == 0).cast("double")).alias("zero_ratio"))
    ac = ts.lag_autocorr(tr.where(F.col("date") >= F.lit(_ACF_CUTOFF)), "sales", 7, keys)
    val = p.where(F.col("date").between(F.lit(_V0), F.lit(_V1))).select(*keys).distinct()
    # one row per series; materialised once because the five picks read it repeatedly
    from shelfcast.session import materialize
    sv = materialize(stt.join(ac, keys).join(val, keys, "left_semi"), "series-selection")
    med = F.lit(summarize(sv, {"cv": [0.5]})["cv"].quantiles[0])
    order = {"mean_desc": [F.col("mean").desc()], "mean_asc": [F.col("mean").asc()],
             "acf": [F.col("acf_lag7").desc()], "zero": [F.col("zero_ratio").desc()], "cv": [F.col("cv").desc()]}
    steps = [(1, "high_stable", F.col("cv") <= med, "mean_desc"),
             (2, "low_sales", (F.col("zero_ratio") < 0.3) & (F.col("mean") > 0), "mean_asc"),
             (3, "seasonality", F.lit(True), "acf"),
             (4, "many_zeros", F.col("zero_ratio") > 0.3, "zero"),
             (5, "high_volatility", F.lit(True), "cv")]
    chosen = None
    out = None
    for pick, name, cond, o in steps:
        cand = sv.where(cond)
        if chosen is not None:
            cand = anti_join(cand, chosen, keys)
        one = cand.orderBy(*order[o], *keys).limit(1).select(F.lit(pick).alias("pick"), F.lit(name).alias("pattern"), *keys)
        chosen = one.select(*keys) if chosen is None else chosen.unionByName(one.select(*keys))
        out = one if out is None else out.unionByName(one)
    return out


register("representative_series", with_views(REPR_SQL + "SELECT * FROM representative"), ids="TS-12, TS-03, T-03, J-06, J-07")(
    representative_df)


@register("acf7_per_series", with_views(REPR_SQL + "SELECT store_nbr, family, round(acf_lag7, 6) AS acf_lag7 FROM ac"),
          ids="TS-03, A-28")
def acf7_per_series(spark, sf):
    p = fx.sales_panel(spark, sf)
    tr = p.where(F.col("date").between(F.lit(_ACF_CUTOFF), F.lit(_TRAIN_END)))
    a = ts.lag_autocorr(tr, "sales", 7, ["store_nbr", "family"])
    return a.select("store_nbr", "family", F.round("acf_lag7", 6).alias("acf_lag7"))


STORE_TOT_SQL = f"(SELECT p.store_nbr, s.type, {XSUM.format(x='p.sales')} AS total FROM sales_panel p JOIN stores s ON s.store_nbr = p.store_nbr GROUP BY 1, 2)"


def store_totals(spark, sf):
    t = fx.sales_raw(spark, sf).groupBy("store_nbr").agg(exact_sum("sales").alias("total"))
    return t.join(fx.stores(spark, sf).select("store_nbr", "type"), "store_nbr")


@register("store_rank", with_views(f"""
SELECT store_nbr, total, CAST(rank() OVER (ORDER BY total DESC) + (COUNT(*) OVER (PARTITION BY total) - 1) / 2.0 AS INTEGER) AS rank
FROM {STORE_TOT_SQL}"""), ids="W-14")
def store_rank(spark, sf):
    t = store_totals(spark, sf)
    return average_rank(t, "total", "rank").select("store_nbr", "total", F.col("rank").cast("int").alias("rank"))


RANK_STD_SQL = f"""
  SELECT store_nbr, stddev_samp(rk) AS rank_std FROM (
    SELECT store_nbr, rank() OVER (PARTITION BY y ORDER BY t DESC) + (COUNT(*) OVER (PARTITION BY y, t) - 1) / 2.0 AS rk
    FROM (SELECT store_nbr, year(date) AS y, {XSUM.format(x='sales')} AS t FROM sales_panel GROUP BY 1, 2)) GROUP BY store_nbr"""


def rank_std_df(spark, sf):
    y = fx.sales_panel(spark, sf).groupBy("store_nbr", F.year("date").alias("y")).agg(exact_sum("sales").alias("t"))
    r = average_rank(y, "t", "rk", ["y"])
    return r.groupBy("store_nbr").agg(F.stddev_samp("rk").alias("rank_std"))


@register("rank_stability", with_views(f"SELECT store_nbr, round(rank_std, 9) AS rank_std FROM ({RANK_STD_SQL})"), ids="R-08, W-14")
def rank_stability(spark, sf):
    return rank_std_df(spark, sf).select("store_nbr", F.round("rank_std", 9).alias("rank_std"))


@register("predictability", with_views(f"""
WITH sm AS (SELECT store_nbr, stddev_samp(sales) / (avg(sales) + 1e-9) AS cv, 100.0 * COUNT(*) FILTER (WHERE sales = 0) / COUNT(*) AS zp
            FROM sales_panel GROUP BY store_nbr),
rs AS ({RANK_STD_SQL}),
j AS (SELECT sm.store_nbr, sm.cv, sm.zp, rs.rank_std FROM sm LEFT JOIN rs ON rs.store_nbr = sm.store_nbr),
s AS (SELECT store_nbr, 1 - (cv - min(cv) OVER ()) / NULLIF(max(cv) OVER () - min(cv) OVER (), 0) AS cv_score,
  1 - (zp - min(zp) OVER ()) / NULLIF(max(zp) OVER () - min(zp) OVER (), 0) AS zero_score,
  1 - (rank_std - min(rank_std) OVER ()) / NULLIF(max(rank_std) OVER () - min(rank_std) OVER (), 0) AS stability_score FROM j)
SELECT store_nbr, round(cv_score, 6) AS cv_score, round(zero_score, 6) AS zero_score, round(stability_score, 6) AS stability_score,
  round(0.4 * cv_score + 0.3 * zero_score + 0.3 * stability_score, 6) AS predictability FROM s"""), ids="TS-14, P-21")
def predictability(spark, sf):
    p = fx.sales_panel(spark, sf)
    x = F.col("sales")
    sm = p.groupBy("store_nbr").agg((F.stddev_samp(x) / (F.avg(x) + F.lit(EPS))).alias("cv"),
                                    (F.count_if(x == 0) * 100.0 / F.count(F.lit(1))).alias("zp"))
    j = sm.join(rank_std_df(spark, sf), "store_nbr", "left")
    allw = Window.partitionBy()

    def rescale(c):
        return 1 - F.try_divide(F.col(c) - F.min(c).over(allw), F.max(c).over(allw) - F.min(c).over(allw))
    s = j.select("store_nbr", rescale("cv").alias("cv_score"), rescale("zp").alias("zero_score"),
                 rescale("rank_std").alias("stability_score"))
    score = 0.4 * F.col("cv_score") + 0.3 * F.col("zero_score") + 0.3 * F.col("stability_score")
    return s.select("store_nbr", *[F.round(c, 6).alias(c) for c in ("cv_score", "zero_score", "stability_score")],
                    F.round(score, 6).alias("predictability"))


KW_SQL = f"""
WITH sm AS {STORE_TOT_SQL},
r AS (SELECT type, total, rank() OVER (ORDER BY total) + (COUNT(*) OVER (PARTITION BY total) - 1) / 2.0 AS rk FROM sm),
g AS (SELECT type, COUNT(*) AS n, SUM(rk) AS rs FROM r GROUP BY type),
nn AS (SELECT COUNT(*) AS n FROM sm),
tt AS (SELECT SUM(c * c * c - c) AS tt FROM (SELECT COUNT(*) AS c FROM sm GROUP BY total))
SELECT round(12.0 / (nn.n * (nn.n + 1)) * SUM(g.rs * g.rs / g.n) - 3 * (nn.n + 1), 9) AS h_raw,
  round((12.0 / (nn.n * (nn.n + 1)) * SUM(g.rs * g.rs / g.n) - 3 * (nn.n + 1)) / (1 - tt.tt / (nn.n * nn.n * nn.n - nn.n)), 9) AS h_stat,
  CAST(COUNT(*) - 1 AS INTEGER) AS dof, nn.n AS n_obs
FROM g, nn, tt GROUP BY nn.n, tt.tt"""


def kruskal_df(spark, sf):
    """H statistic from average ranks, N and the tie term, which come from the counts of the distinct totals."""
    t = store_totals(spark, sf)
    r = average_rank(t, "total", "rk", desc=False)
    ties = t.groupBy("total").agg(F.count(F.lit(1)).alias("c")).agg(F.sum("c").alias("n"), F.sum(F.expr("c * c * c - c")).alias("tie"))
    r = r.select("type", "rk", ties.select("n").scalar().alias("_n"), ties.select("tie").scalar().alias("_tie"))
    g = r.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.sum("rk").alias("rs"), F.first("_n").alias("_n"),
                              F.first("_tie").alias("_tie"))
    n = F.first("_n").cast("double")
    h = F.lit(12.0) / (n * (n + 1)) * F.sum(F.col("rs") * F.col("rs") / F.col("n")) - 3 * (n + 1)
    corr = 1 - F.try_divide(F.first("_tie"), n * n * n - n)
    return g.agg(F.round(h, 9).alias("h_raw"), F.round(F.try_divide(h, corr), 9).alias("h_stat"),
                 (F.count(F.lit(1)) - 1).cast("int").alias("dof"), F.first("_n").alias("n_obs"))


register("kruskal_wallis", with_views(KW_SQL), ids="H-01")(kruskal_df)


# the oracle adds up the series of the lower incomplete gamma function instead of the finite sums
@register("kruskal_wallis_pvalue", with_views(f"""
SELECT *, round(1 - list_sum(list_transform(range(0, 400), lambda i: exp((dof / 2.0 + i) * ln(h_stat / 2) - h_stat / 2 - lgamma(dof / 2.0 + i + 1)))), 9) AS p_value
FROM ({KW_SQL})"""), ids="H-01")
def kruskal_wallis_pvalue(spark, sf):
    return kruskal_df(spark, sf).withColumn("p_value", F.round(chi2_sf(F.col("h_stat"), F.col("dof")), 9))


MW_SQL = f"""
WITH sm AS {STORE_TOT_SQL},
pr AS (SELECT a.type AS type_a, b.type AS type_b FROM (SELECT DISTINCT type FROM sm) a JOIN (SELECT DISTINCT type FROM sm) b ON a.type < b.type),
x AS (SELECT pr.type_a, pr.type_b, sm.type, sm.total FROM pr JOIN sm ON sm.type IN (pr.type_a, pr.type_b)),
r AS (SELECT *, rank() OVER (PARTITION BY type_a, type_b ORDER BY total) + (COUNT(*) OVER (PARTITION BY type_a, type_b, total) - 1) / 2.0 AS rk FROM x)
SELECT type_a, type_b, COUNT(*) FILTER (WHERE type = type_a) AS n_a, COUNT(*) FILTER (WHERE type = type_b) AS n_b,
  SUM(CASE WHEN type = type_a THEN rk END) - COUNT(*) FILTER (WHERE type = type_a) * (COUNT(*) FILTER (WHERE type = type_a) + 1) / 2.0 AS u_stat
FROM r GROUP BY type_a, type_b"""


def mann_whitney_df(spark, sf, with_p=False):
    """U of every pair of store types; a store goes once to each pair that its type is in."""
    t = store_totals(spark, sf)
    types = t.agg(F.sort_array(F.collect_set("type"))).scalar()  # one row per type
    x = t.withColumn("other", F.explode(types)).where("other <> type").select(
        F.least("type", "other").alias("type_a"), F.greatest("type", "other").alias("type_b"), "type", "total")
    w = Window.partitionBy("type_a", "type_b").orderBy("total")
    tie = Window.partitionBy("type_a", "type_b", "total")
    r = x.select("type_a", "type_b", "type", "total",
                 (F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0).alias("rk"),
                 F.count(F.lit(1)).over(tie).alias("tc"))
    is_a = F.col("type") == F.col("type_a")
    na = F.count_if(is_a)
    aggs = [na.alias("n_a"), F.count_if(~is_a).alias("n_b"),
            (F.sum(F.when(is_a, F.col("rk"))) - na * (na + 1) / 2.0).alias("u_stat")]
    if not with_p:
        return r.groupBy("type_a", "type_b").agg(*aggs)
    # c**2 - 1 for every member of a tie of c values adds up to c**3 - c for each tied value
    g = r.groupBy("type_a", "type_b").agg(*aggs, F.sum(F.col("tc") ** 2 - 1).alias("_ties"))
    ship_package(spark)

    def p(it):
        for pdf in it:
            pv = [st.mann_whitney_p(u, a, b, t) for u, a, b, t in zip(pdf["u_stat"], pdf["n_a"], pdf["n_b"], pdf["_ties"])]
            stars = ["***" if v < 0.001 else "**" if v < 0.01 else "*" if v < 0.05 else "ns" for v in pv]
            yield pdf.drop(columns="_ties").assign(p_value=pv, significance=stars)
    schema = "type_a string, type_b string, n_a bigint, n_b bigint, u_stat double, p_value double, significance string"
    return g.mapInPandas(p, schema)


register("mann_whitney_pairs", with_views(MW_SQL), ids="H-02")(mann_whitney_df)


@register("mann_whitney_pvalue", None, ids="H-02")
def mann_whitney_pvalue(spark, sf):
    return mann_whitney_df(spark, sf, with_p=True)


FC_SQL = f"""
WITH fd AS (SELECT date, family, {XSUM.format(x='sales')} AS sales FROM sales_panel GROUP BY 1, 2),
top AS (SELECT family FROM fd GROUP BY family ORDER BY SUM(sales) DESC, family LIMIT 12),
f AS (SELECT fd.* FROM fd JOIN top ON top.family = fd.family),
fc AS (SELECT a.family AS family_a, b.family AS family_b, round(corr(a.sales, b.sales), 9) AS corr
       FROM f a JOIN f b ON a.date = b.date AND a.family < b.family GROUP BY 1, 2)
"""


def family_corr_df(spark, sf):
    """Correlations of the daily totals of the 12 largest families; a day meets its own rows only."""
    fd = fx.sales_panel(spark, sf).groupBy("date", "family").agg(exact_sum("sales").alias("sales"))
    top = fd.groupBy("family").agg(F.sum("sales").alias("t")).orderBy(F.col("t").desc(), "family").limit(12)
    f = fd.join(top.select("family"), "family", "left_semi")
    day = f.groupBy("date").agg(F.sort_array(F.collect_list(F.struct("family", "sales"))).alias("of"))  # at most 12
    later = F.transform("of", lambda a: F.transform(F.filter("of", lambda b: b["family"] > a["family"]), lambda b: F.struct(
        a["family"].alias("family_a"), b["family"].alias("family_b"), a["sales"].alias("x"), b["sales"].alias("y"))))
    pairs = day.select(F.inline(F.flatten(later)))
    return pairs.groupBy("family_a", "family_b").agg(F.round(F.corr("x", "y"), 9).alias("corr"))


register("family_corr", with_views(FC_SQL + "SELECT * FROM fc"), ids="TS-13, A-28")(family_corr_df)


@register("top_corr_pairs", with_views(FC_SQL + "SELECT * FROM fc ORDER BY abs(corr) DESC, family_a, family_b LIMIT 10"),
          ids="T-05")
def top_corr_pairs(spark, sf):
    return family_corr_df(spark, sf).orderBy(F.abs("corr").desc(), "family_a", "family_b").limit(10)
