"""Composite jobs: training table, split, safe set, horizon features, sinks (F-06, F-07, F-11, F-13, U-01, S-06..S-08, C-14)."""

from __future__ import annotations


from pyspark.sql import functions as F

from shelfcast.catalog.external import OIL_DAILY_SQL
from shelfcast.catalog.holidays import FLAGS_SQL, VH
from shelfcast.catalog.sqlparts import split_case
from shelfcast.catalog.windows import TEMPORAL_SQL, _lag_sql, _roll_sql
from shelfcast.functions.numeric import exact_sum
from shelfcast.plans import train_final as tf
from shelfcast.plans.features import LAGS, ROLLING_SAFE, ROLLING_SHIFT1, SAFE_LAGS
from shelfcast.plans.split import split_bounds, temporal_split
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import DEFAULT_SPLIT, SHOCK_PERIODS

ROUNDED = list(ROLLING_SHIFT1) + list(ROLLING_SAFE) + ["oil_price_rolling_mean_28", "oil_price_change_pct",
                                                       "store_family_te", "city_freq", "state_freq"]


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if c in ROUNDED else F.col(c) for c in df.columns])


def train_final_df(spark, sf):
    return tf.build_train_final(fx.sales_panel(spark, sf), fx.stores(spark, sf), fx.holidays_events(spark),
                                fx.oil(spark, sf))


TRAIN_FINAL_BODY = f"""
base AS (SELECT row_number() OVER (ORDER BY date, store_nbr, family) - 1 AS id, date, store_nbr, family, sales, onpromotion
         FROM sales_panel),
nn AS (SELECT COUNT(*) AS n FROM base),
lf AS (SELECT base.*, {TEMPORAL_SQL}, {', '.join(_lag_sql(n) for n in LAGS)},
  {_roll_sql(ROLLING_SHIFT1)} FROM base),
fl AS ({FLAGS_SQL}),
vh AS ({VH}),
halo AS (SELECT d.date,
  COALESCE((SELECT min(vh.date) FROM vh WHERE vh.date > d.date) - d.date, -1) AS days_to_next_holiday,
  COALESCE(d.date - (SELECT max(vh.date) FROM vh WHERE vh.date < d.date), -1) AS days_after_last_holiday
  FROM (SELECT DISTINCT date FROM sales_panel) d),
od AS ({OIL_DAILY_SQL}),
se AS (SELECT s.store_nbr, s.type, s.city, s.state, s.cluster,
   CAST(dense_rank() OVER (ORDER BY s.type) - 1 AS INTEGER) AS store_type_encoded FROM stores s),
fte AS (SELECT type, CAST(dense_rank() OVER (ORDER BY type) - 1 AS INTEGER) AS store_type_enc
   FROM (SELECT DISTINCT se.type FROM base JOIN se ON se.store_nbr = base.store_nbr)),
rc AS (SELECT se.city, se.state, COUNT(*) AS c FROM base JOIN se ON se.store_nbr = base.store_nbr GROUP BY 1, 2),
cf AS (SELECT city, SUM(c) / (SELECT SUM(c) FROM rc) AS city_freq FROM rc GROUP BY city),
stf AS (SELECT state, SUM(c) / (SELECT SUM(c) FROM rc) AS state_freq FROM rc GROUP BY state),
fo AS (SELECT base.id, base.sales, CAST(base.store_nbr AS VARCHAR) || '_' || base.family AS store_family,
   CAST(CASE WHEN id < (n % 5) * (n // 5 + 1) THEN id // (n // 5 + 1)
        ELSE (n % 5) + (id - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold FROM base, nn),
fk AS (SELECT fold, store_family, SUM(sales) AS fs, COUNT(sales) AS fn FROM fo GROUP BY 1, 2),
tk AS (SELECT store_family, SUM(sales) AS ts, COUNT(sales) AS tn FROM fo GROUP BY 1),
ff AS (SELECT fold, SUM(sales) AS fsum, COUNT(sales) AS fcnt FROM fo GROUP BY 1),
g AS (SELECT SUM(sales) AS gs, COUNT(sales) AS gn FROM fo),
te AS (SELECT fo.id, fo.store_family,
  CASE WHEN tk.tn - fk.fn > 0 THEN ((tk.tn - fk.fn) * ((tk.ts - fk.fs) / (tk.tn - fk.fn)) + 10 * ((g.gs - ff.fsum) / (g.gn - ff.fcnt)))
       / ((tk.tn - fk.fn) + 10) ELSE (g.gs - ff.fsum) / (g.gn - ff.fcnt) END AS store_family_te
  FROM fo JOIN fk ON fk.fold = fo.fold AND fk.store_family = fo.store_family JOIN tk ON tk.store_family = fo.store_family
  JOIN ff ON ff.fold = fo.fold CROSS JOIN g),
train_final AS (
SELECT lf.*, fl.is_national_holiday, fl.is_regional_holiday, fl.is_local_holiday, fl.is_transferred_holiday,
  fl.holiday_type, fl.is_carnaval_feature, halo.days_to_next_holiday, halo.days_after_last_holiday,
  CASE WHEN lf.date BETWEEN DATE '{SHOCK_PERIODS[0][0]}' AND DATE '{SHOCK_PERIODS[0][1]}' THEN 1 ELSE 0 END AS is_earthquake_period,
  COALESCE(od.oil_price, (SELECT oil_price FROM od ORDER BY date LIMIT 1)) AS oil_price, od.oil_price_lag_7,
  od.oil_price_lag_14, round(od.oil_price_rolling_mean_28, 6) AS oil_price_rolling_mean_28,
  round(od.oil_price_change_pct, 6) AS oil_price_change_pct,
  se.type, se.city, se.state, se.cluster, fte.store_type_enc, round(cf.city_freq, 6) AS city_freq,
  round(stf.state_freq, 6) AS state_freq, se.store_type_encoded,
  te.store_family, round(te.store_family_te, 6) AS store_family_te
FROM lf
JOIN fl ON fl.date = lf.date AND fl.store_nbr = lf.store_nbr AND fl.family = lf.family
JOIN halo ON halo.date = lf.date
LEFT JOIN od ON od.date = lf.date
LEFT JOIN se ON se.store_nbr = lf.store_nbr
LEFT JOIN fte ON fte.type = se.type
LEFT JOIN cf ON cf.city = se.city LEFT JOIN stf ON stf.state = se.state
JOIN te ON te.id = lf.id)"""


def _tf_sql(select: str) -> str:
    return with_views("WITH " + TRAIN_FINAL_BODY + "\n" + select)


@register("train_final", _tf_sql("SELECT * FROM train_final"), ids="F-11, C-12, C-13")
def train_final(spark, sf):
    return _rounded(train_final_df(spark, sf))


@register("temporal_split", _tf_sql(f"""
SELECT split, COUNT(*) AS n_rows, MIN(date) AS min_date, MAX(date) AS max_date,
  CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS total_sales
FROM (SELECT *, {split_case()} AS split FROM train_final) WHERE split IS NOT NULL GROUP BY split"""), ids="F-13, P-15")
def temporal_split_q(spark, sf):
    s = temporal_split(train_final_df(spark, sf))
    return s.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("min_date"),
                                  F.max("date").alias("max_date"), exact_sum("sales").alias("total_sales"))


_RANGES = " UNION ALL ".join(f"SELECT '{n}' AS split, DATE '{a}' AS range_start, DATE '{b}' AS range_end"
                             for n, a, b in DEFAULT_SPLIT.ranges())


@register("dq_split_bounds", with_views(f"""
WITH s AS (SELECT {split_case()} AS split, date FROM sales_panel),
a AS (SELECT split, MIN(date) AS min_date, MAX(date) AS max_date, COUNT(*) AS n_rows FROM s WHERE split IS NOT NULL GROUP BY split),
r AS ({_RANGES})
SELECT a.split, a.min_date, a.max_date, a.n_rows, r.range_start, r.range_end,
  (a.min_date >= r.range_start AND a.max_date <= r.range_end) AS ok
FROM a JOIN r ON r.split = a.split"""), ids="C-14")
def dq_split_bounds(spark, sf):
    return split_bounds(temporal_split(fx.sales_panel(spark, sf)))


@register("safe_feature_set", _tf_sql(f"""
, v3 AS (SELECT train_final.* EXCLUDE (lag_1, lag_2, lag_3, lag_7, rolling_mean_7, rolling_mean_14, rolling_mean_28, rolling_std_7),
  {', '.join(_lag_sql(n) for n in SAFE_LAGS)}, {_roll_sql(ROLLING_SAFE)} FROM train_final)
SELECT v3.* EXCLUDE (id), {split_case()} AS split, round(ln(1 + sales), 9) AS sales_log FROM v3
WHERE {split_case()} IS NOT NULL""".replace("\n, v3", ",\nv3", 1)), ids="F-06, W-02, W-05, C-17")
def safe_feature_set(spark, sf):
    return _rounded(tf.rounded_log_target(tf.safe_feature_set(train_final_df(spark, sf))))
