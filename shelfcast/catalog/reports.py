"""Reshape, top-k and evaluation queries (R-01..R-07, T-02, T-03, V-01..V-04, A-30, TS-15, P-17, P-22, M-06 seasonal naive)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.sqlparts import exact_mean_sql, metrics_sql, rolling_sql, split_case
from shelfcast.functions.numeric import exact_avg, exact_sum
from shelfcast.operators.evaluate import metric_columns, metrics_gap
from shelfcast.plans.features import add_safe_features
from shelfcast.plans.split import temporal_split
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views

XSUM = "CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"
DAILY = f"(SELECT date, {XSUM.format(x='sales')} AS total FROM sales_panel GROUP BY date)"
TYPES = ["A", "B", "C", "D", "E"]


def _selling_stores(spark, sf):
    return fx.stores(spark, sf).join(fx.sales_raw(spark, sf).select("store_nbr").distinct(), "store_nbr", "left_semi")


@register("pivot_cluster_type", with_views("""
SELECT cluster, """ + ", ".join(f"COUNT(*) FILTER (WHERE type = '{t}') AS \"{t}\"" for t in TYPES) + """
FROM stores WHERE store_nbr IN (SELECT DISTINCT store_nbr FROM sales_raw) GROUP BY cluster"""), ids="R-01")
def pivot_cluster_type(spark, sf):
    g = _selling_stores(spark, sf).groupBy("cluster").pivot("type", TYPES).count().na.fill(0)
    return g.select("cluster", *[F.col(t).cast("long").alias(t) for t in TYPES])


@register("pivot_month_dow", with_views(f"""
SELECT month(date) AS month, """ + ", ".join(
    exact_mean_sql(f"CASE WHEN isodow(date) - 1 = {d} THEN total END", None, 6, 4) + f" AS d{d}" for d in range(7))
    + f" FROM {DAILY} GROUP BY 1"), ids="R-02")
def pivot_month_dow(spark, sf):
    d = fx.sales_daily(spark, sf)
    g = d.withColumn("dow", F.weekday("date")).groupBy(F.month("date").alias("month")).pivot(
        "dow", list(range(7))).agg(exact_avg("total", 4))
    return g.select("month", *[F.col(str(i)).alias(f"d{i}") for i in range(7)])


@register("pivot_month_year", with_views(f"""
SELECT month(date) AS month, year(date) AS year, {XSUM.format(x='total')} AS total FROM {DAILY} GROUP BY 1, 2"""), ids="R-03")
def pivot_month_year(spark, sf):
    """Month by year in long form: as many years as the data has."""
    d = fx.sales_daily(spark, sf)
    return d.groupBy(F.month("date").alias("month"), F.year("date").alias("year")).agg(exact_sum("total").alias("total"))


@register("year_week", with_views(f"""
SELECT year(date) AS year, week(date) AS week, {exact_mean_sql('total', None, 6, 4)} AS mean_sales FROM {DAILY} GROUP BY 1, 2"""), ids="R-04")
def year_week(spark, sf):
    d = fx.sales_daily(spark, sf)
    return d.groupBy(F.year("date").alias("year"), F.weekofyear("date").alias("week")).agg(
        exact_avg("total", 4).alias("mean_sales"))


@register("family_type_mix", with_views(f"""
WITH top AS (SELECT family FROM sales_panel GROUP BY family ORDER BY SUM(sales) DESC, family LIMIT 10),
t AS (SELECT p.family, s.type, {XSUM.format(x='p.sales')} AS total FROM sales_panel p JOIN stores s ON s.store_nbr = p.store_nbr
      WHERE p.family IN (SELECT family FROM top) GROUP BY 1, 2)
SELECT family, type, total, round(100.0 * total / SUM(total) OVER (PARTITION BY type), 6) AS pct_of_type FROM t"""), ids="R-05, J-06")
def family_type_mix(spark, sf):
    from pyspark.sql import Window
    p = fx.sales_raw(spark, sf)
    top = p.groupBy("family").agg(F.sum("sales").alias("t")).orderBy(F.col("t").desc(), "family").limit(10).select("family")
    j = p.join(top, "family", "left_semi").join(fx.stores(spark, sf).select("store_nbr", "type"), "store_nbr")
    t = j.groupBy("family", "type").agg(exact_sum("sales").alias("total"))
    return t.select("*", F.round(F.try_divide(100.0 * F.col("total"), F.sum("total").over(Window.partitionBy("type"))), 6).alias("pct_of_type"))


@register("top8_other", with_views(f"""
WITH top AS (SELECT family FROM sales_panel GROUP BY family ORDER BY SUM(sales) DESC, family LIMIT 8)
SELECT date, CASE WHEN family IN (SELECT family FROM top) THEN family ELSE 'Other' END AS bucket, {XSUM.format(x='sales')} AS sales
FROM sales_panel GROUP BY 1, 2"""), ids="R-06")
def top8_other(spark, sf):
    p = fx.sales_panel(spark, sf)
    top = fx.sales_raw(spark, sf).groupBy("family").agg(F.sum("sales").alias("t")).orderBy(F.col("t").desc(), "family").limit(8).select(
        F.col("family").alias("_top"))
    j = p.join(top, p.family == top._top, "left")  # top has at most 8 rows
    b = F.when(F.col("_top").isNotNull(), F.col("family")).otherwise(F.lit("Other"))
    return j.groupBy("date", b.alias("bucket")).agg(exact_sum("sales").alias("sales"))


@register("pivot_family_month", with_views(f"""
WITH fd AS (SELECT date, family, {XSUM.format(x='sales')} AS sales FROM sales_panel GROUP BY 1, 2)
SELECT family, """ + ", ".join(
    exact_mean_sql(f"CASE WHEN month(date) = {m} THEN sales END", None, 6, 4) + f" AS m{m}" for m in range(1, 13))
    + " FROM fd GROUP BY family"), ids="R-07")
def pivot_family_month(spark, sf):
    fd = fx.sales_panel(spark, sf).groupBy("date", "family").agg(exact_sum("sales").alias("sales"))
    g = fd.withColumn("m", F.month("date")).groupBy("family").pivot("m", list(range(1, 13))).agg(exact_avg("sales", 4))
    return g.select("family", *[F.col(str(m)).alias(f"m{m}") for m in range(1, 13)])


@register("top_bottom_stores", with_views(f"""
WITH t AS (SELECT store_nbr, {XSUM.format(x='sales')} AS total FROM sales_panel GROUP BY 1)
SELECT * FROM (SELECT 'top' AS side, store_nbr, total FROM t ORDER BY total DESC, store_nbr LIMIT 10)
UNION ALL SELECT * FROM (SELECT 'bottom', store_nbr, total FROM t ORDER BY total ASC, store_nbr LIMIT 10)"""), ids="T-02")
def top_bottom_stores(spark, sf):
    t = fx.sales_raw(spark, sf).groupBy("store_nbr").agg(exact_sum("sales").alias("total"))
    top = t.orderBy(F.col("total").desc(), "store_nbr").limit(10).select(F.lit("top").alias("side"), "store_nbr", "total")
    bot = t.orderBy(F.col("total").asc(), "store_nbr").limit(10).select(F.lit("bottom").alias("side"), "store_nbr", "total")
    return top.unionByName(bot)


@register("nlargest", with_views("""
SELECT store_nbr, family, round(avg(sales), 6) AS mean FROM sales_panel GROUP BY 1, 2 ORDER BY avg(sales) DESC, store_nbr, family LIMIT 5"""),
          ids="T-03")
def nlargest(spark, sf):
    t = fx.sales_panel(spark, sf).groupBy("store_nbr", "family").agg(F.avg("sales").alias("m"))
    return t.orderBy(F.col("m").desc(), "store_nbr", "family").limit(5).select("store_nbr", "family", F.round("m", 6).alias("mean"))


# ---------------------------------------------------------------- evaluation on seasonal-naive / rolling forecasts

PRED_SQL = f"""
WITH f AS (SELECT date, store_nbr, family, sales AS actual,
   lag(sales, 21) OVER (PARTITION BY store_nbr, family ORDER BY date) AS pred_naive,
   {rolling_sql('sales', 28, 16, 'mean', 1)} AS pred_roll FROM sales_panel),
pr AS (SELECT *, {split_case()} AS split FROM f)
"""


def predictions(spark, sf):
    """Two SQL-expressible forecasters: seasonal naive (value 21 days back) and the safe 28-day mean."""
    f = add_safe_features(fx.sales_panel(spark, sf))
    f = f.select("date", "store_nbr", "family", F.col("sales").alias("actual"), F.col("lag_21").alias("pred_naive"),
                 F.col("rolling_mean_28_safe").alias("pred_roll"))
    return temporal_split(f, keep_unassigned=True)


@register("seasonal_naive", with_views(PRED_SQL + f"""
SELECT split, {metrics_sql('actual', 'pred_naive')} FROM pr WHERE split IS NOT NULL GROUP BY split"""), ids="M-06 (baseline), V-01")
def seasonal_naive(spark, sf):
    return predictions(spark, sf).where(F.col("split").isNotNull()).groupBy("split").agg(*metric_columns("actual", "pred_naive"))


@register("metrics", with_views(PRED_SQL + f"""
SELECT {metrics_sql('actual', 'pred_roll')} FROM pr WHERE split = 'test'"""), ids="V-01")
def metrics_q(spark, sf):
    return predictions(spark, sf).where("split = 'test'").agg(*metric_columns("actual", "pred_roll"))


@register("metrics_by_series", with_views(PRED_SQL + f"""
SELECT store_nbr, family, {metrics_sql('actual', 'pred_naive')} FROM pr WHERE split = 'test' GROUP BY 1, 2"""), ids="V-02")
def metrics_by_series(spark, sf):
    return predictions(spark, sf).where("split = 'test'").groupBy("store_nbr", "family").agg(
        *metric_columns("actual", "pred_naive"))


def _long_metrics(spark, sf):
    p = predictions(spark, sf).where(F.col("split").isin("val", "test"))
    a = p.groupBy("split").agg(F.lit("baseline").alias("model"), *metric_columns("actual", "pred_naive"))
    b = p.groupBy("split").agg(F.lit("tuned").alias("model"), *metric_columns("actual", "pred_roll"))
    return a.unionByName(b)


@register("metrics_gap", with_views(PRED_SQL + f"""
, m AS (SELECT split, 'baseline' AS model, {metrics_sql('actual', 'pred_naive')} FROM pr WHERE split IN ('val', 'test') GROUP BY split
   UNION ALL SELECT split, 'tuned', {metrics_sql('actual', 'pred_roll')} FROM pr WHERE split IN ('val', 'test') GROUP BY split)
SELECT a.split, """ + ", ".join(f"a.{m} AS {m}_baseline, b.{m} AS {m}_tuned, round(b.{m} - a.{m}, 6) AS {m}_gap"
                                for m in ("rmsle", "rmse", "mae", "rmse_log")) + """
FROM m a JOIN m b ON a.split = b.split AND a.model = 'baseline' AND b.model = 'tuned'""").replace("\n, m AS", ",\nm AS", 1),
          ids="V-03")
def metrics_gap_q(spark, sf):
    return metrics_gap(_long_metrics(spark, sf))


@register("model_comparison", with_views(PRED_SQL + """
SELECT store_nbr, family, round(sqrt(avg(power(ln(1 + CASE WHEN pred_naive IS NOT NULL AND actual IS NOT NULL THEN greatest(pred_naive, 0.0) END) - ln(1 + CASE WHEN pred_naive IS NOT NULL AND actual IS NOT NULL THEN greatest(actual, 0.0) END), 2))), 6) AS rmsle_naive,
  round(sqrt(avg(power(ln(1 + CASE WHEN pred_roll IS NOT NULL AND actual IS NOT NULL THEN greatest(pred_roll, 0.0) END) - ln(1 + CASE WHEN pred_roll IS NOT NULL AND actual IS NOT NULL THEN greatest(actual, 0.0) END), 2))), 6) AS rmsle_roll
FROM pr WHERE split = 'test' GROUP BY 1, 2"""), ids="V-04")
def model_comparison(spark, sf):
    p = predictions(spark, sf).where("split = 'test'")
    a = metric_columns("actual", "pred_naive")[0].alias("rmsle_naive")
    b = metric_columns("actual", "pred_roll")[0].alias("rmsle_roll")
    return p.groupBy("store_nbr", "family").agg(a, b)


@register("error_by_day", with_views(PRED_SQL + f"""
SELECT date, {metrics_sql('actual', 'pred_naive')}, round(avg(actual - pred_naive), 6) AS mean_residual FROM pr WHERE split = 'test' GROUP BY date"""),
          ids="A-30, TS-15")
def error_by_day(spark, sf):
    p = predictions(spark, sf).where("split = 'test'")
    return p.groupBy("date").agg(*metric_columns("actual", "pred_naive"),
                                 F.round(F.avg(F.col("actual") - F.col("pred_naive")), 6).alias("mean_residual"))


@register("error_by_holiday", with_views(PRED_SQL + f"""
, hd AS (SELECT DISTINCT date FROM holidays_events)
SELECT (pr.date IN (SELECT date FROM hd)) AS is_holiday, {metrics_sql('actual', 'pred_naive')}
FROM pr WHERE split IN ('val', 'test') GROUP BY 1""".replace("\n, hd AS", ",\nhd AS", 1)), ids="A-30")
def error_by_holiday(spark, sf):
    """Errors on the days of the holiday calendar (every entry counts) and on all others."""
    hd = fx.holidays_events(spark).select("date").distinct().withColumn("_h", F.lit(True))
    p = predictions(spark, sf).where(F.col("split").isin("val", "test")).join(hd, "date", "left")
    return p.groupBy(F.coalesce("_h", F.lit(False)).alias("is_holiday")).agg(*metric_columns("actual", "pred_naive"))


@register("residual_by_day", with_views(PRED_SQL + """
, r AS (SELECT date, avg(actual - pred_naive) AS mean_residual FROM pr WHERE split = 'test' GROUP BY date)
SELECT round(avg(mean_residual), 6) AS residual_mean, round(stddev_samp(mean_residual), 6) AS residual_std, COUNT(*) AS n_days FROM r"""
                                           .replace("\n, r AS", ",\nr AS", 1)), ids="TS-15")
def residual_by_day(spark, sf):
    p = predictions(spark, sf).where("split = 'test'")
    r = p.groupBy("date").agg(F.avg(F.col("actual") - F.col("pred_naive")).alias("m"))
    return r.agg(F.round(F.avg("m"), 6).alias("residual_mean"), F.round(F.stddev_samp("m"), 6).alias("residual_std"),
                 F.count(F.lit(1)).alias("n_days"))


@register("log_roundtrip", with_views("""
SELECT store_nbr, family, round(avg(ln(1 + sales)), 6) AS mean_log, round(avg(greatest(exp(ln(1 + sales)) - 1, 0) - sales), 6) AS roundtrip_err
FROM sales_panel GROUP BY 1, 2"""), ids="P-17")
def log_roundtrip(spark, sf):
    p = fx.sales_panel(spark, sf)
    back = F.greatest(F.expm1(F.log1p("sales")), F.lit(0.0))
    return p.groupBy("store_nbr", "family").agg(F.round(F.avg(F.log1p("sales")), 6).alias("mean_log"),
                                                F.round(F.avg(back - F.col("sales")), 6).alias("roundtrip_err"))


@register("blend_predictions", with_views(PRED_SQL + """
SELECT date, store_nbr, family, round(greatest(exp(0.3 * ln(1 + pred_naive) + 0.7 * ln(1 + pred_roll)) - 1, 0), 4) AS blended
FROM pr WHERE split = 'test'"""), ids="P-22")
def blend_predictions(spark, sf):
    from shelfcast.plans.forecast import blend
    p = predictions(spark, sf).where("split = 'test'")
    return p.select("date", "store_nbr", "family",
                    F.round(blend(F.log1p("pred_naive"), F.log1p("pred_roll"), 0.3, 0.7), 4).alias("blended"))
