"""Oil and store features, dimension joins and encoders (F-04, F-05, J-01..J-03, J-06, J-07, E-01..E-07)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import encoders as enc
from shelfcast.operators.joins import anti_join, join_stores, semi_join
from shelfcast.plans.external import add_oil_features, add_store_features, oil_daily, store_encoding_table
from shelfcast.plans.split import temporal_split
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.catalog.sqlparts import split_case

OIL_DAILY_SQL = """
  SELECT date, oil_price,
    lag(oil_price, 7) OVER (ORDER BY date) AS oil_price_lag_7,
    lag(oil_price, 14) OVER (ORDER BY date) AS oil_price_lag_14,
    CASE WHEN count(oil_price) OVER (ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) >= 7
         THEN avg(oil_price) OVER (ORDER BY date ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING) END AS oil_price_rolling_mean_28,
    oil_price / NULLIF(lag(oil_price, 7) OVER (ORDER BY date), 0) - 1 AS oil_price_change_pct
  FROM (SELECT date, COALESCE(
      last_value(v IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(v IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS oil_price
    FROM (SELECT CAST(g.d AS DATE) AS date, o.dcoilwtico AS v
          FROM (SELECT MIN(date) d0, greatest(MAX(date), (SELECT MAX(date) FROM sales_panel)) d1 FROM oil) b
          CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
          LEFT JOIN oil o ON o.date = CAST(g.d AS DATE)))"""

OIL_FEATS_SQL = f"""
WITH od AS ({OIL_DAILY_SQL})
SELECT d.date, COALESCE(od.oil_price, (SELECT oil_price FROM od ORDER BY date LIMIT 1)) AS oil_price,
  od.oil_price_lag_7, od.oil_price_lag_14, round(od.oil_price_rolling_mean_28, 6) AS oil_price_rolling_mean_28,
  round(od.oil_price_change_pct, 6) AS oil_price_change_pct
FROM (SELECT DISTINCT date FROM sales_panel) d LEFT JOIN od ON od.date = d.date"""


@register("oil_features", with_views(OIL_FEATS_SQL), ids="F-04, W-06..W-09, J-02")
def oil_features(spark, sf):
    d = fx.sales_panel(spark, sf).select("date").distinct()
    f = add_oil_features(d, fx.oil(spark, sf))
    return f.select("date", "oil_price", "oil_price_lag_7", "oil_price_lag_14",
                    F.round("oil_price_rolling_mean_28", 6).alias("oil_price_rolling_mean_28"),
                    F.round("oil_price_change_pct", 6).alias("oil_price_change_pct"))


@register("join_date_dim", with_views(f"""
WITH od AS ({OIL_DAILY_SQL})
SELECT p.date, p.store_nbr, p.family, p.sales, od.oil_price FROM sales_panel p LEFT JOIN od ON od.date = p.date"""),
          ids="J-02")
def join_date_dim(spark, sf):
    p = fx.sales_panel(spark, sf)
    od = oil_daily(fx.oil(spark, sf), end=p.agg(F.max("date")).scalar())
    return p.join(od.select("date", "oil_price"), "date", "left").select(
        "date", "store_nbr", "family", "sales", "oil_price")


@register("join_store_dim", with_views("""
SELECT p.date, p.store_nbr, p.family, s.type, s.city, s.state, s.cluster
FROM sales_panel p LEFT JOIN stores s ON s.store_nbr = p.store_nbr"""), ids="J-01")
def join_store_dim(spark, sf):
    return join_stores(fx.sales_panel(spark, sf).select("date", "store_nbr", "family"), fx.stores(spark, sf))


@register("join_composite", with_views("""
WITH l AS (SELECT date, store_nbr, family, lag(sales, 16) OVER (PARTITION BY store_nbr, family ORDER BY date) AS lag_16
           FROM sales_raw)
SELECT p.date, p.store_nbr, p.family, p.sales, l.lag_16 FROM sales_panel p
LEFT JOIN l ON l.date = p.date AND l.store_nbr = p.store_nbr AND l.family = p.family"""), ids="J-03")
def join_composite(spark, sf):
    from shelfcast.plans.features import add_lag_features
    raw = add_lag_features(fx.sales_raw(spark, sf), lags=[16], rolling={}).select("date", "store_nbr", "family", "lag_16")
    return fx.sales_panel(spark, sf).select("date", "store_nbr", "family", "sales").join(
        raw, ["date", "store_nbr", "family"], "left")


_TOPK = """(SELECT store_nbr, family FROM (SELECT store_nbr, family, SUM(sales) AS t FROM sales_raw GROUP BY 1, 2)
   ORDER BY t DESC, store_nbr, family LIMIT 10)"""


def _top_series(spark, sf, k=10):
    t = fx.sales_raw(spark, sf).groupBy("store_nbr", "family").agg(F.sum("sales").alias("t"))
    return t.orderBy(F.col("t").desc(), "store_nbr", "family").limit(k).select("store_nbr", "family")


@register("semi_join", with_views(f"""
SELECT store_nbr, family, COUNT(*) AS n_days, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS total
FROM sales_raw WHERE (store_nbr, family) IN (SELECT store_nbr, family FROM {_TOPK}) GROUP BY 1, 2"""), ids="J-06")
def semi_join_q(spark, sf):
    from shelfcast.functions.numeric import exact_sum
    r = semi_join(fx.sales_raw(spark, sf), _top_series(spark, sf), ["store_nbr", "family"])
    return r.groupBy("store_nbr", "family").agg(F.count(F.lit(1)).alias("n_days"), exact_sum("sales").alias("total"))


@register("anti_join", with_views(f"""
SELECT DISTINCT store_nbr, family FROM sales_raw r
WHERE NOT EXISTS (SELECT 1 FROM {_TOPK} t WHERE t.store_nbr = r.store_nbr AND t.family = r.family)"""), ids="J-07")
def anti_join_q(spark, sf):
    s = fx.sales_raw(spark, sf).select("store_nbr", "family").distinct()
    return anti_join(s, _top_series(spark, sf), ["store_nbr", "family"])


STORE_ENC_SQL = """
SELECT s.store_nbr, s.type, s.city, s.state, s.cluster,
  CAST(dense_rank() OVER (ORDER BY s.type) - 1 AS INTEGER) AS store_type_enc,
  CAST(dense_rank() OVER (ORDER BY s.type) - 1 AS INTEGER) AS store_type_encoded,
  COUNT(*) OVER (PARTITION BY s.city) / COUNT(*) OVER () AS city_freq,
  COUNT(*) OVER (PARTITION BY s.state) / COUNT(*) OVER () AS state_freq
FROM stores s"""


@register("store_encoding", with_views(STORE_ENC_SQL), ids="F-05, E-03, E-04 (stores base)")
def store_encoding(spark, sf):
    # restricted to stores that sell, so the query grows with the fact
    st = fx.stores(spark, sf)
    t = store_encoding_table(st)
    return t.select("store_nbr", "type", "city", "state", "cluster", "store_type_enc", "store_type_encoded",
                    "city_freq", "state_freq")


@register("store_type_encode", with_views("""
SELECT p.store_nbr, p.family, COUNT(*) AS n_rows, CAST(dense_rank() OVER (ORDER BY s.type) - 1 AS INTEGER) AS store_type_enc
FROM sales_panel p JOIN stores s ON s.store_nbr = p.store_nbr GROUP BY p.store_nbr, p.family, s.type"""), ids="E-03")
def store_type_encode(spark, sf):
    f = add_store_features(fx.sales_panel(spark, sf), fx.stores(spark, sf), "stores")
    return f.groupBy("store_nbr", "family", "store_type_enc").agg(F.count(F.lit(1)).alias("n_rows"))


@register("freq_encode_rows", with_views("""
WITH f AS (SELECT p.store_nbr, s.city, s.state FROM sales_panel p JOIN stores s ON s.store_nbr = p.store_nbr)
SELECT DISTINCT store_nbr, city, state,
  round(COUNT(*) OVER (PARTITION BY city) / COUNT(*) OVER (), 9) AS city_freq,
  round(COUNT(*) OVER (PARTITION BY state) / COUNT(*) OVER (), 9) AS state_freq FROM f"""), ids="E-04 (rows base)")
def freq_encode_rows(spark, sf):
    f = add_store_features(fx.sales_panel(spark, sf), fx.stores(spark, sf), "rows")
    return f.select("store_nbr", "city", "state", F.round("city_freq", 9).alias("city_freq"),
                    F.round("state_freq", 9).alias("state_freq")).distinct()


@register("freq_encode_stores", with_views("""
WITH fr AS (SELECT store_nbr, city, state, COUNT(*) OVER (PARTITION BY city) / COUNT(*) OVER () AS city_freq,
              COUNT(*) OVER (PARTITION BY state) / COUNT(*) OVER () AS state_freq FROM stores)
SELECT p.store_nbr, COUNT(*) AS n_rows, round(min(fr.city_freq), 9) AS city_freq, round(min(fr.state_freq), 9) AS state_freq
FROM sales_panel p JOIN fr ON fr.store_nbr = p.store_nbr GROUP BY p.store_nbr"""), ids="E-04 (stores base)")
def freq_encode_stores(spark, sf):
    f = add_store_features(fx.sales_panel(spark, sf), fx.stores(spark, sf), "stores")
    return f.groupBy("store_nbr").agg(F.count(F.lit(1)).alias("n_rows"),
                                      F.round(F.min("city_freq"), 9).alias("city_freq"),
                                      F.round(F.min("state_freq"), 9).alias("state_freq"))


@register("label_encode", with_views(f"""
WITH sp AS (SELECT family, {split_case()} AS split FROM sales_panel)
SELECT family, CAST(dense_rank() OVER (ORDER BY family) - 1 AS INTEGER) AS family_code, n_rows
FROM (SELECT family, COUNT(*) AS n_rows FROM sp WHERE split IS NOT NULL GROUP BY family)"""), ids="E-01, U-03")
def label_encode_q(spark, sf):
    sp = temporal_split(fx.sales_panel(spark, sf))
    parts = [sp.filter(F.col("split") == s) for s in ("train", "val", "test")]
    e = enc.label_encode(sp, "family", fit_on=parts, code_col="family_code")
    return e.groupBy("family", "family_code").agg(F.count(F.lit(1)).alias("n_rows"))


@register("label_encode_unseen", with_views("""
WITH m AS (SELECT city, CAST(dense_rank() OVER (ORDER BY city) - 1 AS INTEGER) AS city_code
           FROM (SELECT DISTINCT city FROM stores WHERE type = 'A'))
SELECT s.city, COALESCE(m.city_code, -1) AS city_code, COUNT(*) AS n_rows
FROM sales_panel p JOIN stores s ON s.store_nbr = p.store_nbr LEFT JOIN m ON m.city = s.city GROUP BY 1, 2"""),
          ids="E-02")
def label_encode_unseen(spark, sf):
    st = fx.stores(spark, sf)
    f = join_stores(fx.sales_panel(spark, sf).select("store_nbr"), st, ["city"])
    e = enc.label_encode(f, "city", fit_on=[st.filter("type = 'A'")], code_col="city_code", unseen=-1)
    return e.groupBy("city", "city_code").agg(F.count(F.lit(1)).alias("n_rows"))


FOLD_SQL = """
  SELECT t.*, CAST(CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1)
         ELSE (n % 5) + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) END AS INTEGER) AS fold
  FROM (SELECT *, row_number() OVER (ORDER BY date, store_nbr, family) - 1 AS pos FROM {src}) t,
       (SELECT COUNT(*) AS n FROM {src}) c"""


@register("kfold_contiguous", with_views(f"""
WITH tf AS ({FOLD_SQL.format(src='sales_panel')})
SELECT fold, COUNT(*) AS n_rows, MIN(pos) AS first_pos, MAX(pos) AS last_pos, MIN(date) AS first_date, MAX(date) AS last_date
FROM tf GROUP BY fold"""), ids="E-07, W-18")
def kfold_contiguous(spark, sf):
    f = enc.kfold_contiguous(fx.sales_panel(spark, sf), ["date", "store_nbr", "family"], 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.min("row_pos").alias("first_pos"),
                                 F.max("row_pos").alias("last_pos"), F.min("date").alias("first_date"),
                                 F.max("date").alias("last_date"))


@register("target_encode_full", with_views(f"""
WITH sp AS (SELECT *, CAST(store_nbr AS VARCHAR) || '_' || family AS store_family, {split_case()} AS split FROM sales_panel),
tr AS (SELECT * FROM sp WHERE split = 'train'),
pr AS (SELECT avg(sales) AS prior FROM tr),
st AS (SELECT store_family, (COUNT(sales) * avg(sales) + 10 * (SELECT prior FROM pr)) / (COUNT(sales) + 10) AS te
       FROM tr GROUP BY store_family)
SELECT t.store_family, round(COALESCE(st.te, (SELECT prior FROM pr)), 6) AS store_family_te, COUNT(*) AS n_rows
FROM sp t LEFT JOIN st ON st.store_family = t.store_family WHERE t.split = 'test' GROUP BY 1, 2"""), ids="E-05, P-14")
def target_encode_full(spark, sf):
    sp = temporal_split(fx.sales_panel(spark, sf)).withColumn(
        "store_family", F.concat_ws("_", F.col("store_nbr").cast("string"), F.col("family")))
    m = enc.target_encode_fit(sp.filter("split = 'train'"), "store_family", "sales")
    t = enc.target_encode_apply(sp.filter("split = 'test'"), m, "store_family", "store_family_te")
    return t.groupBy("store_family", F.round("store_family_te", 6).alias("store_family_te")).agg(
        F.count(F.lit(1)).alias("n_rows"))


@register("target_encode_oof", with_views(f"""
WITH sp AS (SELECT *, CAST(store_nbr AS VARCHAR) || '_' || family AS store_family FROM sales_panel),
tf AS ({FOLD_SQL.format(src='sp')}),
fk AS (SELECT fold, store_family, SUM(sales) AS fs, COUNT(sales) AS fn FROM tf GROUP BY 1, 2),
tk AS (SELECT store_family, SUM(sales) AS ts, COUNT(sales) AS tn FROM tf GROUP BY 1),
ff AS (SELECT fold, SUM(sales) AS fsum, COUNT(sales) AS fcnt FROM tf GROUP BY 1),
g AS (SELECT SUM(sales) AS gs, COUNT(sales) AS gn FROM tf),
m AS (SELECT fk.fold, fk.store_family,
  CASE WHEN tk.tn - fk.fn > 0 THEN ((tk.tn - fk.fn) * ((tk.ts - fk.fs) / (tk.tn - fk.fn)) + 10 * ((g.gs - ff.fsum) / (g.gn - ff.fcnt)))
       / ((tk.tn - fk.fn) + 10) ELSE (g.gs - ff.fsum) / (g.gn - ff.fcnt) END AS te
  FROM fk JOIN tk ON tk.store_family = fk.store_family JOIN ff ON ff.fold = fk.fold CROSS JOIN g)
SELECT tf.fold, tf.store_family, round(m.te, 6) AS store_family_te, COUNT(*) AS n_rows
FROM tf JOIN m ON m.fold = tf.fold AND m.store_family = tf.store_family GROUP BY 1, 2, 3"""), ids="E-06, E-07")
def target_encode_oof(spark, sf):
    p = fx.sales_panel(spark, sf).withColumn(
        "store_family", F.concat_ws("_", F.col("store_nbr").cast("string"), F.col("family")))
    f = enc.kfold_contiguous(p, ["date", "store_nbr", "family"], 5)
    t = enc.target_encode_oof(f, "store_family", "sales")
    return t.groupBy("fold", "store_family", F.round("store_family_te", 6).alias("store_family_te")).agg(
        F.count(F.lit(1)).alias("n_rows"))
