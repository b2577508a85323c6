"""Aggregation queries (A-01..A-31 except A-24, P-18, P-19, W-13)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import EPS, exact_avg, exact_sum
from shelfcast.catalog.sqlparts import exact_mean_sql
from shelfcast.operators import aggregates as agg
from shelfcast.operators.profile import exact_quantiles
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views

DAILY = "(SELECT date, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS total FROM sales_panel GROUP BY date)"
XSUM = "CAST(SUM(CAST({x} AS DECIMAL(38,6))) AS DOUBLE)"


def daily(spark, sf):
    return fx.sales_daily(spark, sf)


def _stats_sql(x, digits=6):
    return (f"{XSUM.format(x=x)} AS total, round(avg({x}), {digits}) AS mean, round(stddev_samp({x}), {digits}) AS std, "
            f"min({x}) AS min, max({x}) AS max, COUNT({x}) AS n, COUNT(*) FILTER (WHERE {x} = 0) AS zero_count, "
            f"round(avg(CASE WHEN {x} = 0 THEN 1.0 ELSE 0.0 END), {digits}) AS zero_share")


@register("sales_summary", with_views(f"""
SELECT {_stats_sql('sales')}, round(quantile_cont(sales, 0.5), 6) AS median FROM sales_panel"""), ids="A-01")
def sales_summary(spark, sf):
    p = fx.sales_panel(spark, sf)
    s = agg.group_stats(p, [], "sales")
    q = exact_quantiles(p, "sales", [0.5])
    return s.select("*", F.round(q.select("q50").scalar(), 6).alias("median"))


@register("distribution_shape", with_views("""
WITH m AS (SELECT avg(sales) AS mu, stddev_samp(sales) AS sd, stddev_pop(sales) AS sp, max(sales) AS mx, min(sales) AS mn,
                  quantile_cont(sales, 0.25) AS q25, quantile_cont(sales, 0.5) AS q50, quantile_cont(sales, 0.75) AS q75,
                  quantile_cont(sales, 0.99) AS q99 FROM sales_panel),
c AS (SELECT avg(power(sales - mu, 3)) AS m3, avg(power(sales - mu, 2)) AS m2 FROM sales_panel, m)
SELECT round(q25, 6) AS q25, round(q75, 6) AS q75, round(q99, 6) AS q99,
  round(m3 / power(m2, 1.5), 6) AS skewness, round((SELECT kurtosis_pop(sales) FROM sales_panel), 6) AS kurtosis,
  round(sd / mu * 100, 6) AS cv_pct, round(mu - q50, 6) AS mean_median_gap, round(mx / mu, 6) AS max_mean_ratio,
  round((mx - mn) / mu * 100, 6) AS range_pct
FROM m, c"""), ids="A-02")
def distribution_shape(spark, sf):
    p = fx.sales_panel(spark, sf)
    q = exact_quantiles(p, "sales", [0.25, 0.5, 0.75, 0.99])
    s = p.agg(F.avg("sales").alias("mu"), F.stddev_samp("sales").alias("sd"), F.max("sales").alias("mx"),
              F.min("sales").alias("mn"), F.skewness("sales").alias("sk"), F.kurtosis("sales").alias("ku"))
    qq = {k: q.select(k).scalar() for k in ("q25", "q50", "q75", "q99")}
    return s.select(F.round(qq["q25"], 6).alias("q25"), F.round(qq["q75"], 6).alias("q75"),
                    F.round(qq["q99"], 6).alias("q99"), F.round("sk", 6).alias("skewness"),
                    F.round("ku", 6).alias("kurtosis"), F.round(F.try_divide(F.col("sd"), F.col("mu")) * 100, 6).alias("cv_pct"),
                    F.round(F.col("mu") - qq["q50"], 6).alias("mean_median_gap"),
                    F.round(F.try_divide(F.col("mx"), F.col("mu")), 6).alias("max_mean_ratio"),
                    F.round(F.try_divide(F.col("mx") - F.col("mn"), F.col("mu")) * 100, 6).alias("range_pct"))


def _by(key, value):
    sql = with_views(f"SELECT {key}, {XSUM.format(x=value)} AS total, round(avg({value}), 6) AS mean, COUNT(*) AS n "
                     f"FROM sales_panel GROUP BY {key}")

    def fn(spark, sf):
        return fx.sales_panel(spark, sf).groupBy(key).agg(exact_sum(value).alias("total"),
                                                          F.round(F.avg(value), 6).alias("mean"),
                                                          F.count(F.lit(1)).alias("n"))
    return sql, fn


for _k, _key, _val in (("sales_by_store", "store_nbr", "sales"), ("sales_by_family", "family", "sales"),
                       ("promo_by_store", "store_nbr", "onpromotion"), ("promo_by_family", "family", "onpromotion")):
    _s, _f = _by(_key, _val)
    register(_k, _s, ids="A-03")(_f)


@register("daily_sales", with_views(f"SELECT * FROM {DAILY}"), ids="A-04")
def daily_sales(spark, sf):
    return daily(spark, sf)


@register("period_rollup", with_views(f"""
WITH d AS (SELECT date, total FROM {DAILY})
SELECT 'month' AS period, CAST(date_trunc('month', date) AS DATE) AS period_start, {XSUM.format(x='total')} AS total,
  {exact_mean_sql('total', None, 6, 4)} AS mean, round(stddev_samp(total), 2) AS std FROM d GROUP BY 2
UNION ALL SELECT 'quarter', CAST(date_trunc('quarter', date) AS DATE), {XSUM.format(x='total')}, {exact_mean_sql('total', None, 6, 4)},
  round(stddev_samp(total), 2) FROM d GROUP BY 2
UNION ALL SELECT 'year', CAST(date_trunc('year', date) AS DATE), {XSUM.format(x='total')}, {exact_mean_sql('total', None, 6, 4)},
  round(stddev_samp(total), 2) FROM d GROUP BY 2"""), ids="A-05, P-09")
def period_rollup(spark, sf):
    d = daily(spark, sf).select("total", F.trunc("date", "month").alias("m"), F.trunc("date", "quarter").alias("q"),
                                F.trunc("date", "year").alias("y"))
    g = d.groupingSets([["m"], ["q"], ["y"]], "m", "q", "y").agg(
        exact_sum("total").alias("total"), exact_avg("total", 4).alias("mean"),
        F.round(F.stddev_samp("total"), 2).alias("std"), F.grouping_id().alias("_g"))
    period = F.when(F.col("m").isNotNull(), "month").when(F.col("q").isNotNull(), "quarter").otherwise("year")
    return g.select(period.alias("period"), F.coalesce("m", "q", "y").alias("period_start"), "total", "mean", "std")


def _conc_sql(key, value, src="sales_panel"):
    return with_views(f"""
WITH t AS (SELECT {key}, {XSUM.format(x=value)} AS total FROM {src} GROUP BY {key}),
s AS (SELECT {key}, total, round(total / SUM(total) OVER (), 9) AS share,
  row_number() OVER (ORDER BY total DESC, {key}) AS rank,
  round(SUM(total) OVER (ORDER BY total DESC, {key} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / SUM(total) OVER (), 9) AS cum_share
  FROM t)
SELECT s.*, round(SUM(CASE WHEN rank <= 5 THEN total END) OVER () / SUM(total) OVER (), 9) AS top5_share,
  round(SUM(CASE WHEN rank <= 10 THEN total END) OVER () / SUM(total) OVER (), 9) AS top10_share,
  round(MAX(total) OVER () / NULLIF(MIN(total) OVER (), 0), 9) AS max_min_ratio FROM s""")


@register("concentration_store", _conc_sql("store_nbr", "sales"), ids="A-06, W-13")
def concentration_store(spark, sf):
    return agg.concentration(fx.sales_raw(spark, sf), "store_nbr", "sales")


@register("concentration_family", _conc_sql("family", "sales"), ids="A-06, W-13")
def concentration_family(spark, sf):
    return agg.concentration(fx.sales_raw(spark, sf), "family", "sales")


@register("concentration_promo", _conc_sql("store_nbr", "onpromotion"), ids="A-06")
def concentration_promo(spark, sf):
    return agg.concentration(fx.sales_raw(spark, sf), "store_nbr", "onpromotion")


STORE_METRICS_SQL = f"""
  SELECT store_nbr, {_stats_sql('sales')}, round(100.0 * COUNT(*) FILTER (WHERE sales = 0) / COUNT(*), 6) AS zero_sales_pct,
    round(stddev_samp(sales) / (avg(sales) + 1e-9), 6) AS cv
  FROM sales_panel GROUP BY store_nbr"""


def store_metrics_df(spark, sf):
    s = agg.group_stats(fx.sales_panel(spark, sf), "store_nbr", "sales")
    return s.select("*", F.round(F.col("zero_share") * 100, 6).alias("zero_sales_pct"),
                    F.round(agg.cv(F.col("std"), F.col("mean")), 6).alias("cv"))


@register("store_metrics", with_views(STORE_METRICS_SQL), ids="A-07")
def store_metrics(spark, sf):
    p = fx.sales_panel(spark, sf)
    x = F.col("sales")
    return p.groupBy("store_nbr").agg(
        exact_sum(x).alias("total"), F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_samp(x), 6).alias("std"),
        F.min(x).alias("min"), F.max(x).alias("max"), F.count(x).alias("n"), F.count_if(x == 0).alias("zero_count"),
        F.round(F.avg((x == 0).cast("double")), 6).alias("zero_share"),
        F.round(F.count_if(x == 0) * 100.0 / F.count(F.lit(1)), 6).alias("zero_sales_pct"),
        F.round(agg.cv(F.stddev_samp(x), F.avg(x)), 6).alias("cv"))


@register("traffic_by_store", with_views("""
SELECT store_nbr, SUM(transactions) AS total, round(avg(transactions), 6) AS mean, round(stddev_samp(transactions), 6) AS std,
  min(transactions) AS min, max(transactions) AS max, COUNT(*) AS n_days FROM transactions GROUP BY store_nbr"""), ids="A-07")
def traffic_by_store(spark, sf):
    t = fx.transactions(spark, sf)
    x = F.col("transactions")
    return t.groupBy("store_nbr").agg(F.sum(x).alias("total"), F.round(F.avg(x), 6).alias("mean"),
                                      F.round(F.stddev_samp(x), 6).alias("std"), F.min(x).alias("min"),
                                      F.max(x).alias("max"), F.count(F.lit(1)).alias("n_days"))


@register("type_metrics", with_views(f"""
WITH sm AS (SELECT store_nbr, {XSUM.format(x='sales')} AS total, avg(sales) AS mean,
   100.0 * COUNT(*) FILTER (WHERE sales = 0) / COUNT(*) AS zero_pct FROM sales_panel GROUP BY store_nbr)
SELECT s.type, COUNT(*) AS n_stores, round({XSUM.format(x='sm.total')}, 2) AS total_sales,
  round(avg(sm.total), 2) AS mean_store_sales, round(avg(sm.mean), 2) AS mean_daily_sales, round(avg(sm.zero_pct), 2) AS mean_zero_pct
FROM sm JOIN stores s ON s.store_nbr = sm.store_nbr GROUP BY s.type"""), ids="A-08")
def type_metrics(spark, sf):
    p = fx.sales_panel(spark, sf)
    sm = p.groupBy("store_nbr").agg(exact_sum("sales").alias("total"), F.avg("sales").alias("mean"),
                                    (F.count_if(F.col("sales") == 0) * 100.0 / F.count(F.lit(1))).alias("zero_pct"))
    j = sm.join(fx.stores(spark, sf).select("store_nbr", "type"), "store_nbr")
    return j.groupBy("type").agg(F.count(F.lit(1)).alias("n_stores"), F.round(exact_sum("total"), 2).alias("total_sales"),
                                 F.round(F.avg("total"), 2).alias("mean_store_sales"),
                                 F.round(F.avg("mean"), 2).alias("mean_daily_sales"),
                                 F.round(F.avg("zero_pct"), 2).alias("mean_zero_pct"))


FAMILY_DAY_SQL = """
  SELECT date, family, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS sales,
    CAST(SUM(CAST(CASE WHEN COALESCE(onpromotion, 0) > 0 THEN sales ELSE 0 END AS DECIMAL(38,6))) AS DOUBLE) AS promo_sales,
    CAST(SUM(CAST(CASE WHEN COALESCE(onpromotion, 0) > 0 THEN 0 ELSE sales END AS DECIMAL(38,6))) AS DOUBLE) AS nonpromo_sales,
    MAX(CASE WHEN COALESCE(onpromotion, 0) > 0 THEN 1 ELSE 0 END) AS any_promo
  FROM sales_panel GROUP BY date, family"""


def family_day_df(spark, sf):
    p = fx.sales_panel(spark, sf)
    flag = (F.coalesce(F.col("onpromotion"), F.lit(0.0)) > 0).cast("int")
    return p.groupBy("date", "family").agg(
        exact_sum("sales").alias("sales"), exact_sum(F.col("sales") * flag).alias("promo_sales"),
        exact_sum(F.col("sales") * (1 - flag)).alias("nonpromo_sales"), F.max(flag).alias("any_promo"))


register("family_day", with_views(FAMILY_DAY_SQL), ids="A-09, P-11")(family_day_df)

FAMILY_METRICS_SQL = f"""
WITH fd AS ({FAMILY_DAY_SQL}),
m AS (SELECT family, {XSUM.format(x='sales')} AS total_sales, round(avg(sales), 6) AS mean_daily, round(quantile_cont(sales, 0.5), 6) AS median_daily,
  round(stddev_samp(sales), 6) AS std_daily, round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_day_rate,
  round(avg(CAST(any_promo AS DOUBLE)), 6) AS promo_day_rate,
  round(SUM(promo_sales) / (SUM(sales) + 1e-9), 6) AS promo_share, round(stddev_samp(sales) / (avg(sales) + 1e-9), 6) AS cv
  FROM fd GROUP BY family),
pl AS (SELECT family, COUNT(*) AS n_records, round(avg(CASE WHEN onpromotion > 0 THEN 1.0 ELSE 0.0 END), 6) AS promo_rate,
  round(avg(CASE WHEN onpromotion > 0 THEN sales END), 6) AS mean_promo, round(avg(CASE WHEN onpromotion > 0 THEN NULL ELSE sales END), 6) AS mean_nonpromo,
  round(COALESCE(avg(CASE WHEN onpromotion > 0 THEN sales END), 0) / (COALESCE(avg(CASE WHEN onpromotion > 0 THEN NULL ELSE sales END), 0) + 1e-9) - 1, 6) AS promo_lift
  FROM sales_panel GROUP BY family),
av AS (SELECT family, MIN(CASE WHEN sales > 0 THEN date END) AS first_sale, MAX(CASE WHEN sales > 0 THEN date END) AS last_sale
  FROM sales_panel GROUP BY family)
"""


def _family_parts(spark, sf):
    fd = family_day_df(spark, sf)
    x = F.col("sales")
    m = fd.groupBy("family").agg(
        exact_sum(x).alias("total_sales"), F.round(F.avg(x), 6).alias("mean_daily"),
        F.round(F.percentile(x, 0.5), 6).alias("median_daily"), F.round(F.stddev_samp(x), 6).alias("std_daily"),
        F.round(F.avg((x == 0).cast("double")), 6).alias("zero_day_rate"),
        F.round(F.avg(F.col("any_promo").cast("double")), 6).alias("promo_day_rate"),
        F.round(F.sum("promo_sales") / (F.sum(x) + F.lit(EPS)), 6).alias("promo_share"),
        F.round(agg.cv(F.stddev_samp(x), F.avg(x)), 6).alias("cv"))
    p = fx.sales_panel(spark, sf)
    promo = F.col("onpromotion") > 0
    m1 = F.avg(F.when(promo, F.col("sales")))
    m0 = F.avg(F.when(~promo, F.col("sales")))
    pl = p.groupBy("family").agg(
        F.count(F.lit(1)).alias("n_records"), F.round(F.avg(promo.cast("double")), 6).alias("promo_rate"),
        F.round(m1, 6).alias("mean_promo"), F.round(m0, 6).alias("mean_nonpromo"),
        F.round(F.coalesce(m1, F.lit(0.0)) / (F.coalesce(m0, F.lit(0.0)) + F.lit(EPS)) - 1, 6).alias("promo_lift"))
    av = p.groupBy("family").agg(F.min(F.when(F.col("sales") > 0, F.col("date"))).alias("first_sale"),
                                 F.max(F.when(F.col("sales") > 0, F.col("date"))).alias("last_sale"))
    return m, pl, av


@register("family_daily_metrics", with_views(FAMILY_METRICS_SQL + "SELECT * FROM m"), ids="A-10")
def family_daily_metrics(spark, sf):
    return _family_parts(spark, sf)[0]


@register("promo_lift", with_views(FAMILY_METRICS_SQL + "SELECT * FROM pl"), ids="A-11")
def promo_lift(spark, sf):
    return _family_parts(spark, sf)[1]


@register("availability_window", with_views(FAMILY_METRICS_SQL + "SELECT * FROM av"), ids="A-12")
def availability_window(spark, sf):
    return _family_parts(spark, sf)[2]


@register("family_metrics", with_views(FAMILY_METRICS_SQL + """
SELECT m.*, pl.n_records, pl.promo_rate, pl.mean_promo, pl.mean_nonpromo, pl.promo_lift, av.first_sale, av.last_sale,
  round(m.total_sales / SUM(m.total_sales) OVER (), 9) AS sales_share
FROM m JOIN pl ON pl.family = m.family JOIN av ON av.family = m.family"""), ids="A-13, F-14, C-10")
def family_metrics(spark, sf):
    m, pl, av = _family_parts(spark, sf)
    j = m.join(pl, "family").join(av, "family")
    return j.select("*", F.round(F.try_divide(F.col("total_sales"), F.sum("total_sales").over(Window.partitionBy())), 9).alias("sales_share"))


SERIES_STATS_SQL = """
  SELECT store_nbr, family, round(avg(sales), 6) AS mean, round(stddev_samp(sales), 6) AS std, max(sales) AS max_val,
    round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) AS zero_ratio, COUNT(sales) AS n_days,
    round(stddev_samp(sales) / (avg(sales) + 1e-9), 6) AS cv, round(max(sales) / (avg(sales) + 1e-9), 6) AS max_ratio
  FROM sales_panel GROUP BY store_nbr, family"""


def series_stats_df(spark, sf, panel=None):
    p = panel if panel is not None else fx.sales_panel(spark, sf)
    x = F.col("sales")
    return p.groupBy("store_nbr", "family").agg(
        F.round(F.avg(x), 6).alias("mean"), F.round(F.stddev_samp(x), 6).alias("std"), F.max(x).alias("max_val"),
        F.round(F.avg((x == 0).cast("double")), 6).alias("zero_ratio"), F.count(x).alias("n_days"),
        F.round(agg.cv(F.stddev_samp(x), F.avg(x)), 6).alias("cv"),
        F.round(F.max(x) / (F.avg(x) + F.lit(EPS)), 6).alias("max_ratio"))


register("series_stats", with_views(SERIES_STATS_SQL), ids="A-14")(series_stats_df)

_IN_RANGE_H = "(SELECT h.* FROM holidays_events h WHERE h.date BETWEEN (SELECT MIN(date) FROM sales_raw) AND (SELECT MAX(date) FROM sales_raw))"


def _holidays_in_range(spark, sf):
    r = fx.sales_raw(spark, sf).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    h = fx.holidays_events(spark)
    return h.where(F.col("date").between(r.select("a").scalar(), r.select("b").scalar()))


def _freq(df, col):
    c = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return c.select(col, "n", F.round(F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy()), 6).alias("percent"))


def _freq_sql(col, src):
    return with_views(f"SELECT {col}, COUNT(*) AS n, round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (), 6) AS percent "
                      f"FROM {src} GROUP BY {col}")


@register("event_type_freq", _freq_sql("type", _IN_RANGE_H), ids="A-15")
def event_type_freq(spark, sf):
    return _freq(_holidays_in_range(spark, sf), "type")


@register("locale_freq", _freq_sql("locale", _IN_RANGE_H), ids="A-15")
def locale_freq(spark, sf):
    return _freq(_holidays_in_range(spark, sf), "locale")


_SELLING = "(SELECT s.* FROM stores s WHERE s.store_nbr IN (SELECT DISTINCT store_nbr FROM sales_raw))"


def _selling_stores(spark, sf):
    return fx.stores(spark, sf).join(fx.sales_raw(spark, sf).select("store_nbr").distinct(), "store_nbr", "left_semi")


@register("store_type_freq", _freq_sql("type", _SELLING), ids="A-15")
def store_type_freq(spark, sf):
    return _freq(_selling_stores(spark, sf), "type")


@register("geo_concentration", with_views(f"""
WITH st AS (SELECT s.state, s.city, t.total FROM stores s JOIN
  (SELECT store_nbr, {XSUM.format(x='sales')} AS total FROM sales_raw GROUP BY store_nbr) t ON t.store_nbr = s.store_nbr)
SELECT state, city, COUNT(*) AS n_stores, {XSUM.format(x='total')} AS total_sales,
  round(SUM(total) / SUM(SUM(total)) OVER (), 9) AS sales_share FROM st GROUP BY state, city"""), ids="A-15, C-21")
def geo_concentration(spark, sf):
    t = fx.sales_raw(spark, sf).groupBy("store_nbr").agg(exact_sum("sales").alias("total"))
    st = fx.stores(spark, sf).join(t, "store_nbr")
    g = st.groupBy("state", "city").agg(F.count(F.lit(1)).alias("n_stores"), exact_sum("total").alias("total_sales"))
    return g.select("*", F.round(F.try_divide(F.col("total_sales"), F.sum("total_sales").over(Window.partitionBy())), 9).alias("sales_share"))


@register("holiday_profile", with_views(f"""
WITH h AS {_IN_RANGE_H}, d AS (SELECT date, COUNT(*) AS c FROM h GROUP BY date),
mu AS (SELECT year(date) AS year, COUNT(*) AS multi_event_dates FROM d WHERE c > 1 GROUP BY 1),
y AS (SELECT year(date) AS year, COUNT(*) AS n_events,
  round(avg(CASE WHEN transferred THEN 1.0 ELSE 0.0 END), 6) AS transfer_share,
  round(avg(CASE WHEN locale = 'National' THEN 1.0 ELSE 0.0 END), 6) AS national_share FROM h GROUP BY 1)
SELECT y.year, y.n_events, COALESCE(mu.multi_event_dates, 0) AS multi_event_dates, y.transfer_share, y.national_share
FROM y LEFT JOIN mu ON mu.year = y.year"""), ids="A-16")
def holiday_profile(spark, sf):
    h = _holidays_in_range(spark, sf)
    multi = h.groupBy("date").count().where("count > 1").groupBy(F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("multi_event_dates"))
    y = h.groupBy(F.year("date").alias("year")).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.round(F.avg(F.when(F.col("transferred"), 1.0).otherwise(0.0)), 6).alias("transfer_share"),
        F.round(F.avg((F.col("locale") == "National").cast("double")), 6).alias("national_share"))
    return y.join(multi, "year", "left").select("year", "n_events",
                                                F.coalesce("multi_event_dates", F.lit(0)).alias("multi_event_dates"),
                                                "transfer_share", "national_share")


@register("weekly_seasonality", with_views(f"""
WITH dw AS (SELECT isodow(date) - 1 AS day_of_week, avg(total) AS mean_sales FROM {DAILY} GROUP BY 1)
SELECT day_of_week, round(mean_sales, 4) AS mean_sales,
  round(mean_sales - avg(CASE WHEN day_of_week < 5 THEN mean_sales END) OVER (), 4) AS diff_vs_weekday_mean,
  round(avg(CASE WHEN day_of_week >= 5 THEN mean_sales END) OVER () / avg(CASE WHEN day_of_week < 5 THEN mean_sales END) OVER () - 1, 6) AS weekend_uplift,
  day_of_week = arg_max(day_of_week, mean_sales) OVER () AS is_peak
FROM dw"""), ids="A-17, T-04, T-06")
def weekly_seasonality(spark, sf):
    d = daily(spark, sf).groupBy(F.weekday("date").alias("day_of_week")).agg(F.avg("total").alias("mean_sales"))
    all_ = Window.partitionBy()
    wk = F.avg(F.when(F.col("day_of_week") < 5, F.col("mean_sales"))).over(all_)
    we = F.avg(F.when(F.col("day_of_week") >= 5, F.col("mean_sales"))).over(all_)
    return d.select("day_of_week", F.round("mean_sales", 4).alias("mean_sales"),
                    F.round(F.col("mean_sales") - wk, 4).alias("diff_vs_weekday_mean"),
                    F.round(F.try_divide(we, wk) - 1, 6).alias("weekend_uplift"),
                    (F.col("day_of_week") == F.max_by("day_of_week", "mean_sales").over(all_)).alias("is_peak"))


SEASON_SQL = f"""
WITH fd AS (SELECT date, family, {XSUM.format(x='sales')} AS sales FROM sales_panel GROUP BY 1, 2),
mm AS (SELECT family, month(date) AS month, avg(sales) AS month_mean FROM fd GROUP BY 1, 2),
om AS (SELECT family, avg(sales) AS overall_mean FROM fd GROUP BY 1),
si AS (SELECT mm.family, mm.month, round(mm.month_mean / (om.overall_mean + 1e-9), 6) AS seasonality_index
       FROM mm JOIN om ON om.family = mm.family)
"""


def seasonality_index_df(spark, sf):
    fd = fx.sales_panel(spark, sf).groupBy("date", "family").agg(exact_sum("sales").alias("sales"))
    mm = fd.groupBy("family", F.month("date").alias("month")).agg(F.avg("sales").alias("month_mean"))
    om = fd.groupBy("family").agg(F.avg("sales").alias("overall_mean"))
    return mm.join(om, "family").select("family", "month", F.round(F.col("month_mean") / (F.col("overall_mean") + F.lit(EPS)), 6)
                                        .alias("seasonality_index"))


register("seasonality_index", with_views(SEASON_SQL + "SELECT * FROM si"), ids="A-18")(seasonality_index_df)


@register("seasonality_strength", with_views(SEASON_SQL + """
SELECT family, min(seasonality_index) AS min_index, max(seasonality_index) AS max_index,
  round(max(seasonality_index) - min(seasonality_index), 6) AS seasonality_range,
  row_number() OVER (ORDER BY max(seasonality_index) - min(seasonality_index) DESC, family) AS rank
FROM si GROUP BY family"""), ids="A-18")
def seasonality_strength(spark, sf):
    s = seasonality_index_df(spark, sf).groupBy("family").agg(F.min("seasonality_index").alias("min_index"),
                                                              F.max("seasonality_index").alias("max_index"))
    rng = F.col("max_index") - F.col("min_index")
    return s.select("family", "min_index", "max_index", F.round(rng, 6).alias("seasonality_range"),
                    F.row_number().over(Window.orderBy(rng.desc(), "family")).alias("rank"))


@register("seasonal_peaks", with_views(f"""
WITH d AS {DAILY},
m AS (SELECT month(date) AS k, avg(total) AS v FROM d GROUP BY 1),
q AS (SELECT quarter(date) AS k, avg(total) AS v FROM d GROUP BY 1),
w AS (SELECT isodow(date) - 1 AS k, avg(total) AS v FROM d GROUP BY 1)
SELECT (SELECT k FROM m ORDER BY v DESC, k LIMIT 1) AS peak_month, (SELECT k FROM m ORDER BY v ASC, k LIMIT 1) AS low_month,
       (SELECT k FROM q ORDER BY v DESC, k LIMIT 1) AS peak_quarter, (SELECT k FROM w ORDER BY v DESC, k LIMIT 1) AS best_weekday,
       (SELECT k FROM w ORDER BY v ASC, k LIMIT 1) AS worst_weekday"""), ids="A-19, T-04")
def seasonal_peaks(spark, sf):
    d = daily(spark, sf)

    def best(key, asc=False):
        g = d.groupBy(key.alias("k")).agg(F.avg("total").alias("v"))
        o = F.col("v").asc() if asc else F.col("v").desc()
        return g.orderBy(o, "k").select("k").limit(1).scalar()
    one = d.sparkSession.range(1)
    return one.select(best(F.month("date")).alias("peak_month"), best(F.month("date"), True).alias("low_month"),
                      best(F.quarter("date")).alias("peak_quarter"), best(F.weekday("date")).alias("best_weekday"),
                      best(F.weekday("date"), True).alias("worst_weekday"))


@register("growth_rates", with_views(f"""
WITH m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, {XSUM.format(x='total')} AS total FROM {DAILY} GROUP BY 1)
SELECT month, total, round(total / NULLIF(lag(total, 1) OVER (ORDER BY month), 0) - 1, 6) AS mom_growth,
  round(total / NULLIF(lag(total, 12) OVER (ORDER BY month), 0) - 1, 6) AS yoy_growth FROM m"""), ids="A-20, W-07")
def growth_rates(spark, sf):
    from shelfcast.operators.windows import pct_change
    from shelfcast.spec import PanelSpec
    m = daily(spark, sf).groupBy(F.trunc("date", "month").alias("month")).agg(exact_sum("total").alias("total"))
    spec = PanelSpec(date="month", keys=(), target="total")
    return m.select("month", "total", F.round(pct_change("total", 1, spec), 6).alias("mom_growth"),
                    F.round(pct_change("total", 12, spec), 6).alias("yoy_growth"))


@register("cagr", with_views(f"""
WITH y AS (SELECT year(date) AS year, SUM(total) AS total FROM {DAILY} GROUP BY 1)
SELECT round((SELECT total FROM y WHERE year = 1995) / 1.0, 4) AS start_total, round((SELECT total FROM y WHERE year = 2001), 4) AS end_total,
  round(power((SELECT total FROM y WHERE year = 2001) / (SELECT total FROM y WHERE year = 1995), 1.0 / 6) - 1, 9) AS cagr"""),
          ids="A-21")
def cagr(spark, sf):
    y = daily(spark, sf).groupBy(F.year("date").alias("year")).agg(F.sum("total").alias("total"))
    a = F.sum(F.when(F.col("year") == 1995, F.col("total")))
    b = F.sum(F.when(F.col("year") == 2001, F.col("total")))
    return y.agg(F.round(a, 4).alias("start_total"), F.round(b, 4).alias("end_total"),
                 F.round(F.pow(F.try_divide(b, a), 1.0 / 6) - 1, 9).alias("cagr"))


@register("family_growth", with_views(f"""
WITH fd AS (SELECT family, year(date) AS year, {XSUM.format(x='sales')} AS total FROM sales_panel GROUP BY 1, 2)
SELECT family, SUM(CASE WHEN year = 1997 THEN total END) AS total_1997, SUM(CASE WHEN year = 1999 THEN total END) AS total_1999,
  round(SUM(CASE WHEN year = 1999 THEN total END) / (SUM(CASE WHEN year = 1997 THEN total END) + 1e-9) - 1, 9) AS growth
FROM fd GROUP BY family"""), ids="A-22")
def family_growth(spark, sf):
    fd = fx.sales_panel(spark, sf).groupBy("family", F.year("date").alias("year")).agg(exact_sum("sales").alias("total"))
    a = F.sum(F.when(F.col("year") == 1997, F.col("total")))
    b = F.sum(F.when(F.col("year") == 1999, F.col("total")))
    return fd.groupBy("family").agg(a.alias("total_1997"), b.alias("total_1999"),
                                    F.round(b / (a + F.lit(EPS)) - 1, 9).alias("growth"))


REGIME_CASE = """CASE WHEN dcoilwtico > 0 AND dcoilwtico <= 40 THEN 'Low (<$40)' WHEN dcoilwtico > 40 AND dcoilwtico <= 70
  THEN 'Medium ($40-$70)' WHEN dcoilwtico > 70 AND dcoilwtico <= 150 THEN 'High (>$70)' END"""


def regime_col(c="dcoilwtico"):
    x = F.col(c)
    return (F.when((x > 0) & (x <= 40), "Low (<$40)").when((x > 40) & (x <= 70), "Medium ($40-$70)")
            .when((x > 70) & (x <= 150), "High (>$70)"))


@register("oil_regime", with_views(f"SELECT date, dcoilwtico, {REGIME_CASE} AS regime FROM oil"), ids="P-19")
def oil_regime(spark, sf):
    return fx.oil(spark, sf).select("date", "dcoilwtico", regime_col().alias("regime"))


@register("oil_regime_stats", with_views(f"""
WITH o AS (SELECT dcoilwtico, {REGIME_CASE} AS regime FROM oil)
SELECT regime, COUNT(*) AS days, round(avg(dcoilwtico), 6) AS mean, min(dcoilwtico) AS min, max(dcoilwtico) AS max,
  round(COUNT(*) * 100.0 / (SELECT COUNT(*) FROM oil), 6) AS percent,
  (SELECT COUNT(*) FROM oil WHERE dcoilwtico < 40) AS crash_days
FROM o WHERE regime IS NOT NULL GROUP BY regime"""), ids="A-23, P-19")
def oil_regime_stats(spark, sf):
    o = fx.oil(spark, sf)
    n = o.agg(F.count(F.lit(1))).scalar()
    crash = o.agg(F.count_if(F.col("dcoilwtico") < 40)).scalar()
    r = o.select("dcoilwtico", regime_col().alias("regime")).where(F.col("regime").isNotNull())
    return r.groupBy("regime").agg(F.count(F.lit(1)).alias("days"), F.round(F.avg("dcoilwtico"), 6).alias("mean"),
                                   F.min("dcoilwtico").alias("min"), F.max("dcoilwtico").alias("max"),
                                   F.round(F.count(F.lit(1)) * 100.0 / n, 6).alias("percent"), crash.alias("crash_days"))


CAPPED_SQL = f"""(SELECT date, total, least(total, (SELECT quantile_cont(total, 0.99) FROM {DAILY})) AS sales_capped FROM {DAILY})"""


def capped_df(spark, sf):
    d = daily(spark, sf)
    p99 = d.agg(F.percentile("total", 0.99)).scalar()
    return d.select("date", "total", F.least(F.col("total"), p99).alias("sales_capped"))


@register("cap_p99", with_views(f"""
SELECT round((SELECT quantile_cont(total, 0.99) FROM {DAILY}), 4) AS p99, COUNT(*) FILTER (WHERE total > sales_capped) AS capped_days,
  round(SUM(sales_capped), 2) AS capped_total FROM {CAPPED_SQL}"""), ids="P-18")
def cap_p99(spark, sf):
    c = capped_df(spark, sf)
    p99 = daily(spark, sf).agg(F.percentile("total", 0.99)).scalar()
    return c.agg(F.round(p99, 4).alias("p99"), F.count_if(F.col("total") > F.col("sales_capped")).alias("capped_days"),
                 F.round(F.sum("sales_capped"), 2).alias("capped_total"))


@register("five_number", with_views(f"""
WITH c AS {CAPPED_SQL}
SELECT 'year' AS dim, year(date) AS k, {', '.join(f"round(quantile_cont(sales_capped, {p}), 4) AS p{int(p*100)}" for p in (0, .25, .5, .75, 1))}
FROM c GROUP BY 2
UNION ALL SELECT 'day_of_week', isodow(date) - 1, {', '.join(f"round(quantile_cont(sales_capped, {p}), 4)" for p in (0, .25, .5, .75, 1))}
FROM c GROUP BY 2"""), ids="A-25")
def five_number(spark, sf):
    c = capped_df(spark, sf)

    def by(name, key):
        q = F.percentile("sales_capped", [0.0, 0.25, 0.5, 0.75, 1.0])
        g = c.groupBy(key.alias("k")).agg(q.alias("q"))
        return g.select(F.lit(name).alias("dim"), "k", *[F.round(F.col("q")[i], 4).alias(f"p{n}")
                                                         for i, n in enumerate((0, 25, 50, 75, 100))])
    return by("year", F.year("date")).unionByName(by("day_of_week", F.weekday("date")))


@register("histogram50", with_views(f"""
WITH c AS {CAPPED_SQL}, b AS (SELECT min(sales_capped) AS lo, max(sales_capped) AS hi FROM c)
SELECT LEAST(CAST(floor((sales_capped - lo) / ((hi - lo) / 50.0)) AS INTEGER) + 1, 50) AS bin, COUNT(*) AS n
FROM c, b GROUP BY 1"""), ids="A-26")
def histogram50(spark, sf):
    c = capped_df(spark, sf)
    b = c.agg(F.min("sales_capped").alias("lo"), F.max("sales_capped").alias("hi"))
    lo, hi = b.select("lo").scalar(), b.select("hi").scalar()
    binc = F.least(F.coalesce(F.floor(F.try_divide(F.col("sales_capped") - lo, (hi - lo) / 50.0)), F.lit(0)).cast("int") + 1, F.lit(50))
    return c.groupBy(binc.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@register("zero_sales", with_views(f"""
WITH sm AS (SELECT store_nbr, 100.0 * COUNT(*) FILTER (WHERE sales = 0) / COUNT(*) AS zero_pct FROM sales_panel GROUP BY 1)
SELECT store_nbr, round(zero_pct, 6) AS zero_sales_pct,
  CASE WHEN zero_pct > 40 THEN 'high (>40%)' WHEN zero_pct > 30 THEN 'elevated (30-40%)' ELSE 'normal' END AS band,
  (SELECT round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 9) FROM sales_panel) AS zero_record_share,
  (SELECT COUNT(*) FROM {DAILY} WHERE total = 0) AS zero_days
FROM sm"""), ids="A-27")
def zero_sales(spark, sf):
    p = fx.sales_panel(spark, sf)
    sm = p.groupBy("store_nbr").agg((F.count_if(F.col("sales") == 0) * 100.0 / F.count(F.lit(1))).alias("zero_pct"))
    rec = p.agg(F.round(F.avg((F.col("sales") == 0).cast("double")), 9)).scalar()
    zd = daily(spark, sf).agg(F.count_if(F.col("total") == 0)).scalar()
    band = F.when(F.col("zero_pct") > 40, "high (>40%)").when(F.col("zero_pct") > 30, "elevated (30-40%)").otherwise("normal")
    return sm.select("store_nbr", F.round("zero_pct", 6).alias("zero_sales_pct"), band.alias("band"),
                     rec.alias("zero_record_share"), zd.alias("zero_days"))


@register("pareto80", with_views(f"""
WITH t AS (SELECT family, SUM(sales) AS total FROM sales_panel GROUP BY 1),
c AS (SELECT family, row_number() OVER (ORDER BY total DESC, family) AS rank,
  SUM(total) OVER (ORDER BY total DESC, family ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / SUM(total) OVER () AS cum FROM t)
SELECT MIN(rank) AS n_families_80 FROM c WHERE cum >= 0.8"""), ids="A-29")
def pareto80(spark, sf):
    t = fx.sales_raw(spark, sf).groupBy("family").agg(F.sum("sales").alias("total"))
    s = agg.shares(t, "family", "total", digits=15)
    return s.where(F.col("cum_share") >= 0.8).agg(F.min("rank").alias("n_families_80"))


@register("promo_coverage", with_views(f"""
WITH dp AS (SELECT date, SUM(onpromotion) AS promo FROM sales_panel GROUP BY date)
SELECT SUM(onpromotion) AS total_promo_items, round(100.0 * SUM(onpromotion) / COUNT(*), 6) AS items_per_100_rows,
  round(avg(CASE WHEN COALESCE(onpromotion, 0) = 0 THEN 1.0 ELSE 0.0 END), 9) AS zero_promo_share,
  (SELECT COUNT(*) FILTER (WHERE promo > 0) FROM dp) AS promo_days,
  (SELECT round(avg(CASE WHEN promo > 0 THEN 1.0 ELSE 0.0 END), 9) FROM dp) AS promo_day_share
FROM sales_panel"""), ids="A-31")
def promo_coverage(spark, sf):
    p = fx.sales_panel(spark, sf)
    dp = p.groupBy("date").agg(F.sum("onpromotion").alias("promo"))
    d = dp.agg(F.count_if(F.col("promo") > 0).alias("a"), F.round(F.avg((F.col("promo") > 0).cast("double")), 9).alias("b"))
    return p.agg(F.sum("onpromotion").alias("total_promo_items"),
                 F.round(F.sum("onpromotion") * 100.0 / F.count(F.lit(1)), 6).alias("items_per_100_rows"),
                 F.round(F.avg((F.coalesce(F.col("onpromotion"), F.lit(0.0)) == 0).cast("double")), 9).alias("zero_promo_share"),
                 d.select("a").scalar().alias("promo_days"), d.select("b").scalar().alias("promo_day_share"))
