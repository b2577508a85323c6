"""Calendar columns, lags, rolling statistics, differences and fills (P-01..P-06, W-01..W-12, W-17, W-18, J-04, F-01..F-03)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.catalog.sqlparts import exact_mean_sql, rolling_sql
from shelfcast.functions.numeric import exact_avg, exact_sum
from shelfcast.functions.calendar import TEMPORAL_FEATURES, day_name, temporal_columns
from shelfcast.operators.panel import complete_panel, ffill_bfill, interpolate_linear
from shelfcast.operators.windows import CALENDAR, add_difference, rolling_col
from shelfcast.plans.features import (LAGS, ROLLING_SAFE, ROLLING_SHIFT1, SAFE_LAGS, add_lag_features,
                                      add_temporal_features, build_features)
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import PanelSpec

KEYS = ["date", "store_nbr", "family"]
TEMPORAL_SQL = """year(date) AS year, month(date) AS month, day(date) AS day, isodow(date) - 1 AS day_of_week,
  week(date) AS week_of_year, quarter(date) AS quarter, CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN day(date) = 1 THEN 1 ELSE 0 END AS is_month_start,
  CASE WHEN date = last_day(date) THEN 1 ELSE 0 END AS is_month_end,
  CASE WHEN day(date) = 15 OR date = last_day(date) THEN 1 ELSE 0 END AS is_payday"""


def _lag_sql(n: int, value: str = "sales", part: str = "store_nbr, family") -> str:
    return f"lag({value}, {n}) OVER (PARTITION BY {part} ORDER BY date) AS lag_{n}"


def _roll_sql(specs: dict) -> str:
    """Rolling means of sales as exact decimal means rounded half-up to 6 digits; std rounded."""
    out = []
    for k, (w, o, s, m) in specs.items():
        if s == "mean":
            out.append(f"{rolling_sql('sales', w, o, s, m, exact=(4, 6))} AS {k}")
        else:
            out.append(f"round({rolling_sql('sales', w, o, s, m)}, 6) AS {k}")
    return ",\n  ".join(out)


def _round_cols(df, cols, digits=6):
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


@register("temporal_features", with_views(f"SELECT date, store_nbr, family, {TEMPORAL_SQL} FROM sales_panel"),
          ids="F-01, P-01..P-04")
def temporal_features(spark, sf):
    return fx.sales_panel(spark, sf).select(*KEYS, *temporal_columns("date"))


@register("dow_name", with_views(f"""
SELECT dayname(date) AS day_name, isodow(date) - 1 AS day_of_week, COUNT(*) AS n_days,
       {exact_mean_sql('total', None, 6, 6)} AS mean_sales
FROM (SELECT date, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS total FROM sales_panel GROUP BY date) GROUP BY 1, 2"""), ids="P-05, A-04")
def dow_name(spark, sf):
    daily = fx.sales_daily(spark, sf)
    return daily.groupBy(day_name("date").alias("day_name"), F.weekday("date").alias("day_of_week")).agg(
        F.count(F.lit(1)).alias("n_days"), exact_avg("total", 6).alias("mean_sales"))


@register("make_date", with_views("""
SELECT date, make_date(year(date), month(date), day(date)) AS rebuilt,
       make_date(year(date), month(date), day(date)) = date AS same
FROM (SELECT DISTINCT date FROM sales_raw)"""), ids="P-06")
def make_date(spark, sf):
    d = add_temporal_features(fx.sales_raw(spark, sf).select("date").distinct())
    rebuilt = F.make_date("year", "month", "day")
    return d.select("date", rebuilt.alias("rebuilt"), (rebuilt == F.col("date")).alias("same"))


@register("series_lags", with_views(f"""
SELECT date, store_nbr, family, {', '.join(_lag_sql(n) for n in LAGS)} FROM sales_gappy"""), ids="W-01")
def series_lags(spark, sf):
    df = add_lag_features(fx.sales_gappy(spark, sf), lags=LAGS, rolling={})
    return df.select(*KEYS, *[f"lag_{n}" for n in LAGS])


@register("safe_lags", with_views(f"""
SELECT date, store_nbr, family, {', '.join(_lag_sql(n) for n in SAFE_LAGS)} FROM sales_panel"""), ids="W-02")
def safe_lags(spark, sf):
    df = add_lag_features(fx.sales_panel(spark, sf), lags=SAFE_LAGS, rolling={})
    return df.select(*KEYS, *[f"lag_{n}" for n in SAFE_LAGS])


@register("rolling_shift1", with_views(f"""
SELECT date, store_nbr, family,
  {_roll_sql(ROLLING_SHIFT1)}
FROM sales_panel"""), ids="W-03, W-04")
def rolling_shift1(spark, sf):
    df = add_lag_features(fx.sales_panel(spark, sf), lags=[], rolling=ROLLING_SHIFT1)
    return _round_cols(df.select(*KEYS, *ROLLING_SHIFT1), list(ROLLING_SHIFT1))


@register("rolling_safe", with_views(f"""
SELECT date, store_nbr, family,
  {_roll_sql(ROLLING_SAFE)}
FROM sales_panel"""), ids="W-05")
def rolling_safe(spark, sf):
    df = add_lag_features(fx.sales_panel(spark, sf), lags=[], rolling=ROLLING_SAFE)
    return _round_cols(df.select(*KEYS, *ROLLING_SAFE), list(ROLLING_SAFE))


_CAL_LAGS = [1, 7, 14, 16, 28, 364]


@register("calendar_lags", with_views("SELECT date, store_nbr, family, " + ", ".join(
    f"max(sales) OVER (PARTITION BY store_nbr, family ORDER BY date RANGE BETWEEN INTERVAL {n} DAY PRECEDING AND INTERVAL {n} DAY PRECEDING) AS lag_{n}"
    for n in _CAL_LAGS) + " FROM sales_gappy"), ids="J-04, F-02 (calendar mode), P-08")
def calendar_lags(spark, sf):
    df = add_lag_features(fx.sales_gappy(spark, sf), mode=CALENDAR, lags=_CAL_LAGS, rolling={})
    return df.select(*KEYS, *[f"lag_{n}" for n in _CAL_LAGS])


@register("lag_features", with_views(f"""
SELECT date, store_nbr, family, {', '.join(_lag_sql(n) for n in LAGS)},
  {_roll_sql(ROLLING_SHIFT1)}
FROM sales_gappy"""), ids="F-02")
def lag_features(spark, sf):
    df = add_lag_features(fx.sales_gappy(spark, sf))
    cols = [f"lag_{n}" for n in LAGS] + list(ROLLING_SHIFT1)
    return _round_cols(df.select(*KEYS, *cols), list(ROLLING_SHIFT1))


@register("build_features", with_views(f"""
SELECT date, store_nbr, family, sales, {TEMPORAL_SQL}, {', '.join(_lag_sql(n) for n in LAGS)},
  {_roll_sql(ROLLING_SHIFT1)}
FROM sales_panel"""), ids="F-03")
def build_features_q(spark, sf):
    df = build_features(fx.sales_panel(spark, sf))
    cols = TEMPORAL_FEATURES + [f"lag_{n}" for n in LAGS] + list(ROLLING_SHIFT1)
    return _round_cols(df.select(*KEYS, "sales", *cols), list(ROLLING_SHIFT1))


_DAILY = "(SELECT date, SUM(sales) AS total FROM sales_panel GROUP BY date)"


def _daily(spark, sf):
    return fx.sales_panel(spark, sf).groupBy("date").agg(F.sum("sales").alias("total"))


@register("difference", with_views(f"""
WITH d1 AS (SELECT date, total, total - lag(total) OVER (ORDER BY date) AS diff1 FROM {_DAILY}),
     d2 AS (SELECT date, round(diff1, 4) AS diff1, round(diff1 - lag(diff1) OVER (ORDER BY date), 4) AS diff2 FROM d1 WHERE diff1 IS NOT NULL)
SELECT * FROM d2 WHERE diff2 IS NOT NULL"""), ids="W-12")
def difference(spark, sf):
    spec = PanelSpec(keys=(), target="total")
    d = add_difference(_daily(spark, sf), "total", 1, spec, out_col="diff1")
    d = add_difference(d, "diff1", 1, spec, out_col="diff2")
    return d.select("date", F.round("diff1", 4).alias("diff1"), F.round("diff2", 4).alias("diff2"))


@register("rolling_90", with_views(f"""
SELECT date,
  CASE WHEN count(total) OVER w = 90 THEN {exact_mean_sql('total', 'ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW', 6, 4)} END AS rolling_mean_90,
  CASE WHEN count(total) OVER w = 90 THEN round(stddev_samp(total) OVER w, 2) END AS rolling_std_90
FROM {_DAILY} WINDOW w AS (ORDER BY date ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)"""), ids="W-11")
def rolling_90(spark, sf):
    spec = PanelSpec(keys=(), target="total", decimals=6)
    d = _daily(spark, sf)
    return d.select("date",
                    F.round(rolling_col("total", 90, 0, "mean", 90, spec), 4).alias("rolling_mean_90"),
                    F.round(rolling_col("total", 90, 0, "std", 90, spec), 2).alias("rolling_std_90"))


@register("monthly_ma3", with_views(f"""
SELECT month, round(total, 4) AS total,
  CASE WHEN count(total) OVER w = 3 THEN {exact_mean_sql('total', 'ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW', 6, 4)} END AS ma3
FROM (SELECT CAST(date_trunc('month', date) AS DATE) AS month, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS total
      FROM sales_panel GROUP BY 1)
WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""), ids="W-11, P-09")
def monthly_ma3(spark, sf):
    spec = PanelSpec(date="month", keys=(), target="total", decimals=6)
    m = fx.sales_panel(spark, sf).groupBy(F.trunc("date", "month").alias("month")).agg(exact_sum("sales").alias("total"))
    return m.select("month", F.round("total", 4).alias("total"),
                    F.round(rolling_col("total", 3, 0, "mean", 3, spec), 4).alias("ma3"))


_OIL_GRID = """(SELECT CAST(g.d AS DATE) AS date, o.dcoilwtico
   FROM (SELECT MIN(date) d0, MAX(date) d1 FROM oil) b
   CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
   LEFT JOIN oil o ON o.date = CAST(g.d AS DATE))"""


def _oil_grid(spark, sf):
    return complete_panel(fx.oil(spark, sf), PanelSpec(keys=(), target="dcoilwtico"), flag_col=None)


@register("ffill_bfill", with_views(f"""
SELECT date, dcoilwtico AS raw,
  COALESCE(last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
           first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS oil_price
FROM {_OIL_GRID}"""), ids="W-09, TS-01")
def ffill_bfill_q(spark, sf):
    g = _oil_grid(spark, sf).withColumn("raw", F.col("dcoilwtico"))
    return ffill_bfill(g, ["dcoilwtico"]).select("date", "raw", F.col("dcoilwtico").alias("oil_price"))


@register("interpolate_linear", with_views(f"""
WITH g AS (SELECT date, dcoilwtico FROM {_OIL_GRID}),
k AS (SELECT date, dcoilwtico,
  last_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
  last_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
  first_value(dcoilwtico IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
  first_value(CASE WHEN dcoilwtico IS NOT NULL THEN date END IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
  FROM g)
SELECT date, round(CASE WHEN dcoilwtico IS NOT NULL THEN dcoilwtico
  ELSE COALESCE(pv + (nv - pv) * COALESCE(CAST(date - pd AS DOUBLE) / NULLIF(CAST(nd - pd AS DOUBLE), 0), 0.0), pv, nv) END, 6) AS oil_interp
FROM k"""), ids="W-10")
def interpolate_linear_q(spark, sf):
    g = interpolate_linear(_oil_grid(spark, sf), "dcoilwtico", out_col="oil_interp")
    return g.select("date", F.round("oil_interp", 6).alias("oil_interp"))


@register("tail_n", with_views("""
SELECT date, store_nbr, family, sales FROM (
  SELECT *, row_number() OVER (PARTITION BY store_nbr, family ORDER BY date DESC) AS rn
  FROM sales_panel WHERE date <= DATE '2001-09-19') WHERE rn <= 3"""), ids="W-17, W-16")
def tail_n(spark, sf):
    p = fx.sales_panel(spark, sf).filter(F.col("date") <= F.lit("2001-09-19").cast("date"))
    w = Window.partitionBy("store_nbr", "family").orderBy(F.col("date").desc())
    return p.withColumn("rn", F.row_number().over(w)).filter("rn <= 3").select(*KEYS, "sales")


@register("row_position", with_views("""
SELECT date, store_nbr, family,
  row_number() OVER (ORDER BY date, store_nbr, family) - 1 AS row_pos FROM sales_panel"""), ids="W-18")
def row_position_q(spark, sf):
    from shelfcast.operators.encoders import row_position
    return row_position(fx.sales_panel(spark, sf), ["date", "store_nbr", "family"]).select(*KEYS, "row_pos")
