"""Time-series analysis operators (TS-02..TS-07).

Everything is per series (`keys`, possibly empty for one aggregated series) and runs as
windows partitioned by the series keys and as array functions over a series' aggregates.
A group is one series: its size is the number of days. Unit-root tests: `unitroot.py`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _w(keys, order="date"):
    return Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)


def decompose(df: DataFrame, value: str, period: int, model: str = "additive", keys=(), date: str = "date") -> DataFrame:
    """Classical decomposition (centred moving average trend, phase-mean seasonal, residual).

    Odd periods use a plain centred mean of `period` values; even periods the 2 x p
    filter (half weight at both ends). Trend is NULL where the window is not full.
    """
    keys = list(keys)
    w = _w(keys, date)
    h = period // 2
    if period % 2:
        fr = w.rowsBetween(-h, h)
        trend = F.when(F.count(value).over(fr) == period, F.avg(value).over(fr))
    else:
        fr = w.rowsBetween(-h, h)
        ends = F.lag(value, h).over(w) + F.lead(value, h).over(w)
        s = F.sum(value).over(fr)
        trend = F.when(F.count(value).over(fr) == period + 1, (s - ends / 2.0) / period)
    x = F.col(value)
    out = df.select(*keys, date, value, trend.alias("trend"),
                    ((F.row_number().over(w) - 1) % period).alias("_phase"))
    det = (x - F.col("trend")) if model == "additive" else F.try_divide(x, F.col("trend"))
    out = out.withColumn("_det", det)
    phase_w = Window.partitionBy(*keys, "_phase")
    out = out.withColumn("_pm", F.avg("_det").over(phase_w))
    # normalise the p phase means: each phase mean weighs once
    first_of_phase = F.row_number().over(Window.partitionBy(*keys, "_phase").orderBy(date)) == 1
    norm = F.avg(F.when(first_of_phase, F.col("_pm"))).over(Window.partitionBy(*keys)) if keys else \
        F.avg(F.when(first_of_phase, F.col("_pm"))).over(Window.partitionBy())
    out = out.withColumn("_first", first_of_phase).withColumn("_norm", norm)
    if model == "additive":
        seasonal = F.col("_pm") - F.col("_norm")
        resid = x - F.col("trend") - F.col("seasonal")
    else:
        seasonal = F.try_divide(F.col("_pm"), F.col("_norm"))
        resid = F.try_divide(x, F.col("trend") * F.col("seasonal"))
    out = out.withColumn("seasonal", seasonal).withColumn("resid", resid)
    return out.select(*keys, date, value, "trend", "seasonal", "resid")


def decomposition_strength(dec: DataFrame, keys=()) -> DataFrame:
    """Strength of trend and seasonality: max(0, 1 - var(resid) / var(component + resid)), population variances."""
    keys = list(keys)
    r = F.col("resid")
    both = F.col("trend").isNotNull() & r.isNotNull()
    vr = F.var_pop(F.when(both, r))
    trend_s = F.greatest(F.lit(0.0), 1 - F.try_divide(vr, F.var_pop(F.when(both, F.col("trend") + r))))
    seas_s = F.greatest(F.lit(0.0), 1 - F.try_divide(vr, F.var_pop(F.when(both, F.col("seasonal") + r))))
    aggs = [trend_s.alias("trend_strength"), seas_s.alias("seasonal_strength")]
    return dec.groupBy(*keys).agg(*aggs) if keys else dec.agg(*aggs)


def acf(df: DataFrame, value: str, nlags: int = 60, keys=(), date: str = "date", alpha_z: float = 1.959963984540054):
    """Biased autocorrelation to `nlags` per series with Bartlett's band, long form (keys, lag, acf, band).

    The lagged products are windows over the series; all lags are summed in one aggregate.
    """
    keys = list(keys)
    w = _w(keys, date)
    kw = Window.partitionBy(*keys) if keys else Window.partitionBy()
    d = df.select(*keys, date, (F.col(value) - F.avg(value).over(kw)).alias("_c"))
    prods = [(F.col("_c") * F.lag("_c", k).over(w)).alias(f"_p{k}") for k in range(1, nlags + 1)]
    d = d.select(*keys, "_c", *prods)
    aggs = [F.sum(F.col("_c") * F.col("_c")).alias("_p0"), F.count("_c").alias("_n")]
    aggs += [F.sum(f"_p{k}").alias(f"_p{k}") for k in range(1, nlags + 1)]
    s = d.groupBy(*keys).agg(*aggs) if keys else d.agg(*aggs)
    arr = F.array(*[F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_p{k}"), F.col("_p0")).alias("acf"))
                    for k in range(0, nlags + 1)])
    long = s.select(*keys, "_n", F.inline(arr))
    lw = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("lag")
    cum = F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf")).otherwise(0.0)).over(
        lw.rowsBetween(Window.unboundedPreceding, -1))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        alpha_z * F.sqrt((1 + 2 * F.coalesce(cum, F.lit(0.0))) / F.col("_n")))
    return long.select(*keys, "lag", "acf", band.alias("band"))


def lag_autocorr(df: DataFrame, value: str, lag: int, keys, date: str = "date", min_n: int = 14) -> DataFrame:
    """Pearson correlation of x and x lagged by `lag` rows per series; 0 when n <= min_n or std = 0 (TS-03)."""
    w = _w(keys, date)
    d = df.select(*keys, value, F.lag(value, lag).over(w).alias("_lag"))
    g = d.groupBy(*keys).agg(F.corr(value, "_lag").alias("_r"), F.count(value).alias("_n"),
                             F.stddev_pop(value).alias("_sd"))
    ok = (F.col("_n") > min_n) & (F.col("_sd") > 0)
    return g.select(*keys, F.when(ok, F.coalesce(F.col("_r"), F.lit(0.0))).otherwise(0.0).alias(f"acf_lag{lag}"))


# ---------------------------------------------------------------- recursions over a series' aggregates

def pacf_from_acf(acf_df: DataFrame, keys=()) -> DataFrame:
    """Partial autocorrelations from the ACF table by the Durbin-Levinson recursion (keys, lag, pacf).

    One array of autocorrelations per series; lag k takes the coefficients of lag k - 1.
    """
    keys = list(keys)
    rows = acf_df.groupBy(*keys).agg(F.transform(F.sort_array(F.collect_list(F.struct("lag", "acf"))), lambda x: x["acf"]).alias("_r"))
    r = F.col("_r")

    def step(s, k):
        before = F.reverse(F.slice(r, F.lit(2), k - 1))  # r[k-1] .. r[1]
        known = F.aggregate(F.zip_with(s["phi"], before, lambda p, x: p * x), F.lit(0.0), lambda a, x: a + x)
        a = F.try_divide(F.element_at(r, k + 1) - known, s["v"])
        phi = F.concat(F.zip_with(s["phi"], F.reverse(s["phi"]), lambda p, q: p - a * q), F.array(a))
        return F.struct(phi.alias("phi"), (s["v"] * (1 - a * a)).alias("v"), F.concat(s["out"], F.array(a)).alias("out"))

    # the start's types admit nulls: a series without variance has null coefficients
    one, null = F.when(F.size(r) > 0, F.lit(1.0)), F.lit(None).cast("double")
    start = F.struct(F.slice(F.array(null), 1, 0).alias("phi"), one.alias("v"), F.array(one).alias("out"))
    found = F.aggregate(F.sequence(F.lit(1), F.size(r) - 1), start, step)["out"]
    return rows.select(*keys, F.posexplode(found).alias("lag", "pacf"))
