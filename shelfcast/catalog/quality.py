"""Profiling and data-quality queries (C-01..C-22, R-09, P-17..P-19)."""

from __future__ import annotations


from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.catalog.sqlparts import rolling_sql
from shelfcast.operators import profile as prof
from shelfcast.operators.windows import lag_col
from shelfcast.plans.cleaning import clean_transactions, dedup_sum, drop_negative, split_valid
from shelfcast.plans.features import LAGS, ROLLING_SAFE, SAFE_LAGS, add_lag_features, add_safe_features
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import DEFAULT_SPLIT, HORIZON_DAYS


def _q(col, p):
    return f"quantile_cont({col}, {p})"


@register("profile_describe", with_views("""
SELECT 'sales' AS column, COUNT(sales) AS count, round(avg(sales), 6) AS mean, round(stddev_samp(sales), 6) AS std,
  min(sales) AS min, round(quantile_cont(sales, 0.25), 6) AS p25, round(quantile_cont(sales, 0.5), 6) AS p50,
  round(quantile_cont(sales, 0.75), 6) AS p75, max(sales) AS max FROM sales_raw
UNION ALL
SELECT 'onpromotion', COUNT(onpromotion), round(avg(onpromotion), 6), round(stddev_samp(onpromotion), 6),
  min(onpromotion), round(quantile_cont(onpromotion, 0.25), 6), round(quantile_cont(onpromotion, 0.5), 6),
  round(quantile_cont(onpromotion, 0.75), 6), max(onpromotion) FROM sales_raw"""), ids="C-01")
def profile_describe(spark, sf):
    return prof.describe(fx.sales_raw(spark, sf), ["sales", "onpromotion"])


_LAGCOLS = [f"lag_{n}" for n in LAGS]


def _lag_sel(src="sales_gappy"):
    return ", ".join(f"lag(sales, {n}) OVER (PARTITION BY store_nbr, family ORDER BY date) AS lag_{n}" for n in LAGS)


_MISSING_SQL = """
WITH l AS (SELECT {sel} FROM sales_gappy), n AS (SELECT COUNT(*) AS n FROM l),
u AS ({union})
SELECT u.column, u.missing, round(u.missing * 100.0 / n.n, 6) AS percent{extra} FROM u, n WHERE u.missing > 0"""


def _missing_sql(extra=""):
    union = " UNION ALL ".join(f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL) AS missing FROM l"
                               for c in _LAGCOLS)
    return with_views(_MISSING_SQL.format(sel=_lag_sel(), union=union, extra=extra))


@register("missing_summary", _missing_sql(), ids="C-02")
def missing_summary(spark, sf):
    f = add_lag_features(fx.sales_gappy(spark, sf), lags=LAGS, rolling={})
    return prof.missing_summary(f, _LAGCOLS)


@register("null_rate_flag", _missing_sql(", (u.missing * 100.0 / n.n) > 5.0 AS high_null"), ids="C-03")
def null_rate_flag(spark, sf):
    f = add_lag_features(fx.sales_gappy(spark, sf), lags=LAGS, rolling={})
    return prof.missing_summary(f, _LAGCOLS, threshold=0.05)


@register("feature_ranges", with_views("""
WITH t AS (SELECT year(date) AS year, month(date) AS month, isodow(date) - 1 AS day_of_week, week(date) AS week_of_year,
  lag(sales, 364) OVER (PARTITION BY store_nbr, family ORDER BY date) AS lag_364 FROM sales_panel)
SELECT 'year' AS column, CAST(min(year) AS DOUBLE) AS min, CAST(max(year) AS DOUBLE) AS max, COUNT(*) FILTER (WHERE year IS NULL) AS nulls FROM t
UNION ALL SELECT 'month', min(month), max(month), COUNT(*) FILTER (WHERE month IS NULL) FROM t
UNION ALL SELECT 'day_of_week', min(day_of_week), max(day_of_week), COUNT(*) FILTER (WHERE day_of_week IS NULL) FROM t
UNION ALL SELECT 'week_of_year', min(week_of_year), max(week_of_year), COUNT(*) FILTER (WHERE week_of_year IS NULL) FROM t
UNION ALL SELECT 'lag_364', min(lag_364), max(lag_364), COUNT(*) FILTER (WHERE lag_364 IS NULL) FROM t"""), ids="R-09")
def feature_ranges(spark, sf):
    from shelfcast.plans.features import add_temporal_features
    f = add_lag_features(add_temporal_features(fx.sales_panel(spark, sf)), lags=[364], rolling={})
    return prof.value_ranges(f, ["year", "month", "day_of_week", "week_of_year", "lag_364"])


# The raw file as it might come: some dates that aren't one, counts as words, fractions or negative
# numbers, stores left out, blanks around values, rows that stand twice. By rule, from the rows themselves.
_RAW_TX_SQL = """(WITH b AS (SELECT date, store_nbr, transactions, store_nbr * 7 + day(date) * 3 + month(date) AS z FROM transactions),
  d AS (SELECT *, 1 AS copy FROM b UNION ALL SELECT *, 2 FROM b WHERE z % 17 = 0)
  SELECT CASE WHEN z % 41 = 1 THEN strftime(date, '%Y-13-%d') WHEN z % 41 = 2 THEN 'unknown' WHEN z % 41 = 3 THEN NULL ELSE strftime(date, '%Y-%m-%d') END AS date,
    CASE WHEN z % 37 = 1 THEN '' WHEN z % 37 = 2 THEN 'S' || store_nbr WHEN z % 37 = 3 THEN ' ' || store_nbr || ' ' ELSE CAST(store_nbr AS VARCHAR) END AS store_nbr,
    CASE WHEN z % 31 = 1 THEN 'n/a' WHEN z % 31 = 2 THEN CAST(transactions AS VARCHAR) || '.5' WHEN z % 31 = 3 THEN CAST(-transactions AS VARCHAR)
      WHEN z % 31 = 4 THEN CAST(transactions AS VARCHAR) || '.0' ELSE CAST(transactions AS VARCHAR) END AS transactions FROM d)"""


def _raw_tx(spark, sf):
    t = fx.transactions(spark, sf).withColumn("z", F.col("store_nbr") * 7 + F.dayofmonth("date") * 3 + F.month("date"))
    t = t.withColumn("copy", F.explode(F.when(F.col("z") % 17 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    z, store, n = F.col("z"), F.col("store_nbr").cast("string"), F.col("transactions").cast("string")
    day = F.when(z % 41 == 1, F.date_format("date", "yyyy-'13'-dd")).when(z % 41 == 2, "unknown").when(z % 41 == 3, F.lit(None)).otherwise(F.date_format("date", "yyyy-MM-dd"))
    store = F.when(z % 37 == 1, "").when(z % 37 == 2, F.concat(F.lit("S"), store)).when(z % 37 == 3, F.concat(F.lit(" "), store, F.lit(" "))).otherwise(store)
    n = F.when(z % 31 == 1, "n/a").when(z % 31 == 2, F.concat(n, F.lit(".5"))).when(z % 31 == 3, (-F.col("transactions")).cast("string")).when(z % 31 == 4, F.concat(n, F.lit(".0"))).otherwise(n)
    return t.select(day.alias("date"), store.alias("store_nbr"), n.alias("transactions"))


_TYPED_SQL = """t AS (SELECT *, TRY_CAST(trim(date) AS DATE) AS d, TRY_CAST(trim(store_nbr) AS DOUBLE) AS s, TRY_CAST(trim(transactions) AS DOUBLE) AS n FROM """ + _RAW_TX_SQL + """),
m AS (SELECT *, CASE WHEN d IS NULL THEN 'bad date' WHEN s IS NULL OR s <> floor(s) THEN 'bad store' WHEN n IS NULL OR n <> floor(n) THEN 'bad count' WHEN n < 0 THEN 'negative count' END AS reason FROM t)"""


@register("coerce_drop", with_views(f"""WITH {_TYPED_SQL}
SELECT d AS date, CAST(s AS INTEGER) AS store_nbr, CAST(n AS BIGINT) AS transactions FROM m WHERE reason IS NULL"""), ids="C-05, C-06")
def coerce_drop(spark, sf):
    return split_valid(_raw_tx(spark, sf)).rows


@register("clean_rejects", with_views(f"""WITH {_TYPED_SQL}
SELECT date, store_nbr, transactions, reason FROM m WHERE reason IS NOT NULL"""), ids="C-05, C-06, C-07")
def clean_rejects(spark, sf):
    return split_valid(_raw_tx(spark, sf)).rejects


@register("clean_counts", with_views(f"""WITH {_TYPED_SQL}
SELECT 'rows' AS what, COUNT(*) AS n FROM m UNION ALL SELECT 'accepted', COUNT(*) FILTER (WHERE reason IS NULL) FROM m
""" + "".join(f"UNION ALL SELECT '{r}', COUNT(*) FILTER (WHERE reason = '{r}') FROM m " for r in ("bad date", "bad store", "bad count", "negative count"))), ids="C-05, C-06, C-07")
def clean_counts(spark, sf):
    """Observed in the one pass that types the rows, not counted afterwards."""
    counts = split_valid(_raw_tx(spark, sf)).counts
    return spark.range(1).select(F.inline(F.array(*(F.struct(F.lit(k).alias("what"), F.lit(v).cast("long").alias("n")) for k, v in counts.items()))))


@register("drop_negative", with_views("""
SELECT date, store_nbr, transactions - 2 AS transactions FROM transactions WHERE transactions - 2 >= 0"""), ids="C-07")
def drop_negative_q(spark, sf):
    # shifted counts create negatives to drop
    t = fx.transactions(spark, sf).withColumn("transactions", F.col("transactions") - 2)
    return drop_negative(t, "transactions")


@register("dedup_sum", with_views(f"""WITH {_TYPED_SQL}
SELECT d AS date, CAST(s AS INTEGER) AS store_nbr, CAST(SUM(n) AS BIGINT) AS transactions FROM m WHERE reason IS NULL GROUP BY 1, 2"""), ids="C-08")
def dedup_sum_q(spark, sf):
    return dedup_sum(split_valid(_raw_tx(spark, sf)).rows, ["date", "store_nbr"], "transactions")


@register("clean_transactions", with_views(f"""WITH {_TYPED_SQL},
d AS (SELECT d AS date, CAST(s AS INTEGER) AS store_nbr, CAST(SUM(n) AS BIGINT) AS transactions FROM m WHERE reason IS NULL GROUP BY 1, 2)
SELECT strftime(CAST(g.d AS DATE), '%Y-%m-%d') AS date, k.store_nbr, CAST(COALESCE(d.transactions, 0) AS BIGINT) AS transactions,
  CASE WHEN d.store_nbr IS NULL THEN 1 ELSE 0 END AS is_imputed
FROM (SELECT DISTINCT store_nbr FROM d) k CROSS JOIN (SELECT MIN(date) d0, MAX(date) d1 FROM d) b
CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
LEFT JOIN d ON d.store_nbr = k.store_nbr AND d.date = CAST(g.d AS DATE)"""), ids="C-04..C-11, P-07")
def clean_transactions_q(spark, sf):
    return clean_transactions(_raw_tx(spark, sf), fractions=False)


@register("dq_raw_duplicates", with_views("""
SELECT COUNT(*) AS dup_keys, COALESCE(SUM(c - 1), 0) AS dup_rows FROM (SELECT date, store_nbr, COUNT(*) AS c FROM """ + _RAW_TX_SQL + """ WHERE date IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) > 1)"""), ids="C-12")
def dq_raw_duplicates(spark, sf):
    return prof.duplicate_key_count(_raw_tx(spark, sf).where("date is not null"), ["date", "store_nbr"])


@register("dq_raw_nulls", with_views("""
SELECT 'date' AS column, COUNT(*) FILTER (WHERE date IS NULL) AS nulls, COUNT(*) AS n_rows FROM """ + _RAW_TX_SQL + """
UNION ALL SELECT 'transactions', COUNT(*) FILTER (WHERE transactions IS NULL), COUNT(*) FROM """ + _RAW_TX_SQL), ids="C-13")
def dq_raw_nulls(spark, sf):
    return prof.null_counts(_raw_tx(spark, sf), ["date", "transactions"])


@register("dq_duplicate_keys", with_views("""
SELECT COUNT(*) AS dup_keys, COALESCE(SUM(c - 1), 0) AS dup_rows FROM (
  SELECT date, store_nbr, family, COUNT(*) AS c FROM sales_panel GROUP BY 1, 2, 3 HAVING COUNT(*) > 1)"""), ids="C-12")
def dq_duplicate_keys(spark, sf):
    return prof.duplicate_key_count(fx.sales_panel(spark, sf), ["date", "store_nbr", "family"])


@register("dq_target_nulls", with_views("""
SELECT 'sales' AS column, COUNT(*) FILTER (WHERE sales IS NULL) AS nulls, COUNT(*) AS n_rows FROM sales_panel"""),
          ids="C-13")
def dq_target_nulls(spark, sf):
    return prof.null_counts(fx.sales_panel(spark, sf), ["sales"])


@register("dq_join_fanout", with_views("""
SELECT 'stores' AS dimension, COUNT(*) AS n_rows, COUNT(*) - COUNT(DISTINCT store_nbr) AS surplus_rows FROM stores
UNION ALL SELECT 'oil', COUNT(*), COUNT(*) - COUNT(DISTINCT date) FROM oil
UNION ALL SELECT 'transactions', COUNT(*), COUNT(*) - COUNT(DISTINCT (date, store_nbr)) FROM transactions"""), ids="C-15")
def dq_join_fanout(spark, sf):
    def one(name, df, keys):
        return df.agg(F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("n_rows"),
                      (F.count(F.lit(1)) - F.count_distinct(*[F.col(k) for k in keys])).alias("surplus_rows"))
    return one("stores", fx.stores(spark, sf), ["store_nbr"]).unionByName(
        one("oil", fx.oil(spark, sf), ["date"])).unionByName(
        one("transactions", fx.transactions(spark, sf), ["date", "store_nbr"]))


_T0, _T1 = DEFAULT_SPLIT.test
_SAFE_COLS = [f"lag_{n}" for n in SAFE_LAGS] + list(ROLLING_SAFE)


@register("dq_safe_nulls", with_views("""
WITH f AS (SELECT date, """ + ", ".join(
    [f"lag(sales, {n}) OVER (PARTITION BY store_nbr, family ORDER BY date) AS lag_{n}" for n in SAFE_LAGS]
    + [f"{rolling_sql('sales', w, o, s, m)} AS {k}" for k, (w, o, s, m) in ROLLING_SAFE.items()]) + """ FROM sales_panel),
t AS (SELECT * FROM f WHERE date BETWEEN DATE '""" + str(_T0) + "' AND DATE '" + str(_T1) + """')
""" + " UNION ALL ".join(f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, COUNT(*) AS n_rows FROM t"
                         for c in _SAFE_COLS)), ids="C-16")
def dq_safe_nulls(spark, sf):
    f = add_safe_features(fx.sales_panel(spark, sf))
    return prof.null_counts(f, _SAFE_COLS, F.col("date").between(F.lit(_T0), F.lit(_T1)))


@register("dq_first_lag_null", with_views("""
WITH f AS (SELECT lag(sales, 1) OVER (PARTITION BY store_nbr, family ORDER BY date) AS lag_1,
  row_number() OVER (PARTITION BY store_nbr, family ORDER BY date) AS rn FROM sales_gappy)
SELECT COUNT(*) AS first_rows, COUNT(*) FILTER (WHERE lag_1 IS NOT NULL) AS violations FROM f WHERE rn = 1"""),
          ids="C-18, W-16")
def dq_first_lag_null(spark, sf):
    w = Window.partitionBy("store_nbr", "family").orderBy("date")
    f = fx.sales_gappy(spark, sf).select(lag_col("sales", 1).alias("lag_1"), F.row_number().over(w).alias("rn"))
    return f.where("rn = 1").agg(F.count(F.lit(1)).alias("first_rows"),
                                 F.count_if(F.col("lag_1").isNotNull()).alias("violations"))


@register("dq_ranges", with_views("""
WITH fr AS (SELECT store_nbr, COUNT(*) OVER (PARTITION BY city) / COUNT(*) OVER () AS city_freq FROM stores)
SELECT (SELECT COUNT(*) FROM sales_panel p JOIN fr ON fr.store_nbr = p.store_nbr WHERE NOT (city_freq BETWEEN 0 AND 1)) AS freq_out_of_range,
       (SELECT COUNT(*) FROM sales_panel WHERE sales < 0) AS negative_sales,
       (SELECT COUNT(*) FROM sales_panel WHERE sales IS NULL) AS null_sales,
       (SELECT COUNT(*) FROM oil WHERE dcoilwtico <= 0) AS nonpositive_oil"""), ids="C-19")
def dq_ranges(spark, sf):
    from shelfcast.plans.external import add_store_features
    p = fx.sales_panel(spark, sf)
    f = add_store_features(p, fx.stores(spark, sf), "stores")
    a = f.agg(F.count_if(~F.col("city_freq").between(0, 1)).alias("freq_out_of_range"),
              F.count_if(F.col("sales") < 0).alias("negative_sales"),
              F.count_if(F.col("sales").isNull()).alias("null_sales"))
    o = fx.oil(spark, sf).agg(F.count_if(F.col("dcoilwtico") <= 0).alias("nonpositive_oil"))
    return a.select("*", o.select("nonpositive_oil").scalar().alias("nonpositive_oil"))


_TRACE = [("lag_14", 14, 14), ("lag_16", 16, 16), ("lag_21", 21, 21), ("lag_28", 28, 28), ("lag_35", 35, 35),
          ("lag_364", 364, 364), ("rolling_mean_30", 16, 45), ("rolling_mean_28_safe", 16, 43),
          ("rolling_std_28_safe", 16, 43)]


@register("lookback_trace", with_views("""
WITH e AS (SELECT MAX(date) AS train_end FROM sales_panel),
h AS (SELECT CAST(e.train_end + INTERVAL (k) DAY AS DATE) AS date, e.train_end FROM e CROSS JOIN range(1, """ + str(HORIZON_DAYS + 1) + """) t(k)),
f AS (SELECT * FROM (VALUES """ + ", ".join(f"('{n}', {a}, {b})" for n, a, b in _TRACE) + """) v(feature, newest, oldest))
SELECT h.date, f.feature, CAST(h.date - INTERVAL (f.newest) DAY AS DATE) AS newest_source,
  CAST(h.date - INTERVAL (f.oldest) DAY AS DATE) AS oldest_source,
  CAST(h.date - INTERVAL (f.newest) DAY AS DATE) <= h.train_end AS safe
FROM h CROSS JOIN f"""), ids="C-20")
def lookback_trace(spark, sf):
    end = fx.sales_panel(spark, sf).agg(F.max("date").alias("train_end"))
    days = end.select("train_end", F.explode(F.sequence(F.lit(1), F.lit(HORIZON_DAYS))).alias("k")).select(
        F.date_add("train_end", F.col("k")).alias("date"), "train_end")
    feats = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(a).alias("newest"), F.lit(b).alias("oldest"))
                      for n, a, b in _TRACE])
    j = days.select("*", F.inline(feats))
    return j.select("date", "feature", F.date_sub("date", F.col("newest")).alias("newest_source"),
                    F.date_sub("date", F.col("oldest")).alias("oldest_source"),
                    (F.date_sub("date", F.col("newest")) <= F.col("train_end")).alias("safe"))


@register("lag_coverage", with_views("""
WITH l AS (SELECT """ + _lag_sel() + """ FROM sales_gappy)
""" + " UNION ALL ".join(f"SELECT '{c}' AS column, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls, "
                         f"round(avg(CASE WHEN {c} IS NOT NULL THEN 1.0 ELSE 0.0 END), 9) AS covered FROM l"
                         for c in _LAGCOLS)), ids="C-22")
def lag_coverage(spark, sf):
    f = add_lag_features(fx.sales_gappy(spark, sf), lags=LAGS, rolling={})
    return prof.coverage(f, _LAGCOLS)
