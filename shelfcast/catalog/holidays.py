"""Holiday queries (F-08..F-10, F-12, J-05, J-08, J-10, W-15, P-10, P-12, P-13, A-24)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.calendar import in_periods
from shelfcast.functions.numeric import exact_avg, exact_sum
from shelfcast.catalog.sqlparts import exact_mean_sql
from shelfcast.operators.panel import complete_panel, interpolate_linear
from shelfcast.plans import holidays as hol
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import SHOCK_PERIODS, PanelSpec

VH = """SELECT *, COALESCE(CASE type WHEN 'Holiday' THEN 1 WHEN 'Event' THEN 2 WHEN 'Additional' THEN 3
      WHEN 'Transfer' THEN 4 WHEN 'Bridge' THEN 5 WHEN 'Work Day' THEN 0 END, 0) AS holiday_type_encoded,
    CASE WHEN COALESCE(contains(lower(description), 'carnaval'), false) THEN 1 ELSE 0 END AS is_carnaval,
    CASE WHEN type = 'Transfer' THEN 1 ELSE 0 END AS is_makeup
  FROM holidays_events WHERE transferred = false"""

FLAGS_SQL = f"""
WITH vh AS ({VH}),
f AS (SELECT p.date, p.store_nbr, p.family, s.city, s.state FROM sales_panel p LEFT JOIN stores s ON p.store_nbr = s.store_nbr),
m AS (SELECT f.date, f.store_nbr, f.family, vh.locale, vh.event_seq, vh.holiday_type_encoded, vh.is_carnaval, vh.is_makeup
      FROM f JOIN vh ON vh.date = f.date AND (vh.locale = 'National' OR (vh.locale = 'Regional' AND vh.locale_name = f.state)
                                           OR (vh.locale = 'Local' AND vh.locale_name = f.city)))
SELECT f.date, f.store_nbr, f.family,
  COALESCE(max(CASE WHEN m.locale = 'National' THEN 1 END), 0) AS is_national_holiday,
  COALESCE(max(CASE WHEN m.locale = 'Regional' THEN 1 END), 0) AS is_regional_holiday,
  COALESCE(max(CASE WHEN m.locale = 'Local' THEN 1 END), 0) AS is_local_holiday,
  COALESCE(arg_max(m.is_makeup, m.event_seq), 0) AS is_transferred_holiday,
  COALESCE(arg_max(m.holiday_type_encoded, m.event_seq), 0) AS holiday_type,
  COALESCE(arg_max(m.is_carnaval, m.event_seq), 0) AS is_carnaval_feature
FROM f LEFT JOIN m ON m.date = f.date AND m.store_nbr = f.store_nbr AND m.family = f.family
GROUP BY f.date, f.store_nbr, f.family"""

FLAG_COLS = ["is_national_holiday", "is_regional_holiday", "is_local_holiday", "is_transferred_holiday",
             "holiday_type", "is_carnaval_feature"]


@register("holiday_flags", with_views(FLAGS_SQL), ids="F-09, J-05")
def holiday_flags(spark, sf):
    p = fx.sales_panel(spark, sf).select("date", "store_nbr", "family")
    return hol.add_holiday_flags(p, fx.stores(spark, sf), fx.holidays_events(spark))


@register("valid_holidays", with_views(f"""
WITH vh AS ({VH})
SELECT d.date, vh.event_seq, vh.type, vh.holiday_type_encoded, vh.is_carnaval, vh.is_makeup
FROM (SELECT DISTINCT date FROM sales_raw) d JOIN vh ON vh.date = d.date"""), ids="F-08, P-12, P-13, P-16")
def valid_holidays_q(spark, sf):
    d = fx.sales_raw(spark, sf).select("date").distinct()
    vh = hol.valid_holidays(fx.holidays_events(spark))
    return d.join(vh, "date").select("date", "event_seq", "type", "holiday_type_encoded",
                                                  "is_carnaval", "is_makeup")


@register("holiday_halo", with_views(f"""
WITH vh AS ({VH}), d AS (SELECT DISTINCT date FROM sales_panel)
SELECT d.date,
  COALESCE((SELECT min(vh.date) FROM vh WHERE vh.date > d.date) - d.date, -1) AS days_to_next_holiday,
  COALESCE(d.date - (SELECT max(vh.date) FROM vh WHERE vh.date < d.date), -1) AS days_after_last_holiday
FROM d"""), ids="F-10, J-08")
def holiday_halo(spark, sf):
    return hol.holiday_halo(fx.sales_panel(spark, sf).select("date"), fx.holidays_events(spark))


@register("shock_period_flag", with_views(f"""
SELECT date, CASE WHEN date BETWEEN DATE '{SHOCK_PERIODS[0][0]}' AND DATE '{SHOCK_PERIODS[0][1]}' THEN 1 ELSE 0 END
  AS is_earthquake_period, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS sales
FROM sales_panel GROUP BY date"""), ids="P-10")
def shock_period_flag(spark, sf):
    d = fx.sales_daily(spark, sf).withColumnRenamed("total", "sales")
    return d.withColumn("is_earthquake_period", in_periods("date", SHOCK_PERIODS))


@register("holiday_features", with_views(f"""
WITH fl AS ({FLAGS_SQL}), vh AS ({VH}), d AS (SELECT DISTINCT date FROM sales_panel),
halo AS (SELECT d.date,
  COALESCE((SELECT min(vh.date) FROM vh WHERE vh.date > d.date) - d.date, -1) AS days_to_next_holiday,
  COALESCE(d.date - (SELECT max(vh.date) FROM vh WHERE vh.date < d.date), -1) AS days_after_last_holiday FROM d)
SELECT fl.*, halo.days_to_next_holiday, halo.days_after_last_holiday,
  CASE WHEN fl.date BETWEEN DATE '{SHOCK_PERIODS[0][0]}' AND DATE '{SHOCK_PERIODS[0][1]}' THEN 1 ELSE 0 END AS is_earthquake_period
FROM fl JOIN halo ON fl.date = halo.date"""), ids="F-08..F-10")
def holiday_features(spark, sf):
    p = fx.sales_panel(spark, sf).select("date", "store_nbr", "family")
    return hol.add_holiday_features(p, fx.stores(spark, sf), fx.holidays_events(spark))


PRIORITY_SQL = "CASE type WHEN 'Bridge' THEN 1 WHEN 'Transfer' THEN 2 WHEN 'Holiday' THEN 3 ELSE 4 END"


@register("dedup_priority", with_views(f"""
SELECT date, event_seq, type, locale, priority FROM (
  SELECT h.*, {PRIORITY_SQL} AS priority,
         row_number() OVER (PARTITION BY h.date ORDER BY {PRIORITY_SQL}, h.event_seq) AS rn
  FROM holidays_events h JOIN (SELECT DISTINCT date FROM sales_raw) d ON d.date = h.date) WHERE rn = 1"""),
          ids="W-15")
def dedup_priority(spark, sf):
    d = fx.sales_raw(spark, sf).select("date").distinct()
    h = fx.holidays_events(spark).join(d, "date", "left_semi")
    return hol.dedup_priority(h).select("date", "event_seq", "type", "locale", "priority")


OIL_INTERP_SQL = """
  SELECT date, CASE WHEN v IS NOT NULL THEN v
    ELSE COALESCE(pv + (nv - pv) * COALESCE(CAST(date - pd AS DOUBLE) / NULLIF(CAST(nd - pd AS DOUBLE), 0), 0.0), pv, nv) END AS dcoilwtico
  FROM (SELECT date, v,
    last_value(v IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pv,
    last_value(CASE WHEN v IS NOT NULL THEN date END IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pd,
    first_value(v IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
    first_value(CASE WHEN v IS NOT NULL THEN date END IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nd
    FROM (SELECT CAST(g.d AS DATE) AS date, o.dcoilwtico AS v
          FROM (SELECT MIN(date) d0, MAX(date) d1 FROM oil) b
          CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
          LEFT JOIN oil o ON o.date = CAST(g.d AS DATE)))"""

ANALYSIS_SQL = f"""
WITH daily AS (SELECT date, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS sales FROM sales_panel GROUP BY date),
oi AS ({OIL_INTERP_SQL}),
top AS (SELECT date, type, locale, description, transferred FROM (
  SELECT h.*, row_number() OVER (PARTITION BY date ORDER BY {PRIORITY_SQL}, event_seq) AS rn FROM holidays_events h) WHERE rn = 1),
d AS (SELECT daily.date, daily.sales, round(oi.dcoilwtico, 6) AS dcoilwtico, top.type, top.locale,
        (top.type IS NOT NULL AND COALESCE(top.transferred, true) = false) AS is_holiday_event,
        COALESCE(top.type, 'Normal') AS holiday_category, COALESCE(top.locale, 'None') AS locale_category
      FROM daily LEFT JOIN oi ON oi.date = daily.date LEFT JOIN top ON top.date = daily.date),
ev AS (SELECT date FROM d WHERE is_holiday_event),
per AS (SELECT date, min(r) AS r FROM (
   SELECT CAST(ev.date + INTERVAL (o) DAY AS DATE) AS date, CASE WHEN o = 0 THEN 1 WHEN o < 0 THEN 2 ELSE 3 END AS r
   FROM ev CROSS JOIN range(-2, 3) t(o)) GROUP BY date)
SELECT d.*, CASE per.r WHEN 1 THEN 'During Holiday' WHEN 2 THEN 'Before Holiday' WHEN 3 THEN 'After Holiday' ELSE 'Normal' END AS period_type
FROM d LEFT JOIN per ON per.date = d.date"""


def analysis_table(spark, sf):
    daily = fx.sales_daily(spark, sf).withColumnRenamed("total", "sales")
    g = complete_panel(fx.oil(spark, sf), PanelSpec(keys=(), target="dcoilwtico"), flag_col=None)
    oi = interpolate_linear(g, "dcoilwtico").select("date", F.round("dcoilwtico", 6).alias("dcoilwtico"))
    t = hol.holiday_analysis(daily, oi, fx.holidays_events(spark))
    return t.select("date", "sales", "dcoilwtico", "type", "locale", "is_holiday_event", "holiday_category",
                    "locale_category", "period_type")


register("holiday_analysis", with_views(ANALYSIS_SQL), ids="F-12, J-10, W-15, P-23")(analysis_table)


@register("holiday_window", with_views(f"""
WITH a AS ({ANALYSIS_SQL}) SELECT period_type, COUNT(*) AS n_days FROM a GROUP BY period_type"""), ids="J-10")
def holiday_window(spark, sf):
    return analysis_table(spark, sf).groupBy("period_type").agg(F.count(F.lit(1)).alias("n_days"))


def _impact(df, by):
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_days"),
        exact_avg("sales", 4).alias("mean_sales"),
        F.round(F.percentile("sales", 0.25), 4).alias("q25"),
        F.round(F.percentile("sales", 0.5), 4).alias("median"),
        F.round(F.percentile("sales", 0.75), 4).alias("q75"),
    )


def _impact_sql(by, where="TRUE"):
    return with_views(f"""
WITH a AS ({ANALYSIS_SQL})
SELECT {by}, COUNT(*) AS n_days, {exact_mean_sql('sales', None, 6, 4)} AS mean_sales,
  round(quantile_cont(sales, 0.25), 4) AS q25, round(quantile_cont(sales, 0.5), 4) AS median,
  round(quantile_cont(sales, 0.75), 4) AS q75
FROM a WHERE {where} GROUP BY {by}""")


@register("holiday_impact", _impact_sql("is_holiday_event, holiday_category"), ids="A-24")
def holiday_impact(spark, sf):
    return _impact(analysis_table(spark, sf), ["is_holiday_event", "holiday_category"])


@register("locale_impact", _impact_sql("locale_category", "locale_category <> 'None'"), ids="A-24")
def locale_impact(spark, sf):
    return _impact(analysis_table(spark, sf).filter("locale_category <> 'None'"), ["locale_category"])


@register("period_impact", _impact_sql("period_type"), ids="A-24")
def period_impact(spark, sf):
    return _impact(analysis_table(spark, sf), ["period_type"])


@register("oil_lag_corr", with_views(f"""
WITH a AS ({ANALYSIS_SQL}),
l AS (SELECT sales, """ + ", ".join(f"lag(dcoilwtico, {n}) OVER (ORDER BY date) AS oil_lag_{n}" for n in (1, 7, 14, 30, 365)) + """ FROM a)
SELECT """ + ", ".join(f"round(corr(sales, oil_lag_{n}), 6) AS corr_lag_{n}" for n in (1, 7, 14, 30, 365)) + " FROM l"),
          ids="TS-04, W-08")
def oil_lag_corr(spark, sf):
    from shelfcast.operators.windows import lag_col
    spec = PanelSpec(keys=(), target="dcoilwtico")
    a = analysis_table(spark, sf)
    lags = (1, 7, 14, 30, 365)
    a = a.select("sales", *[lag_col("dcoilwtico", n, spec).alias(f"oil_lag_{n}") for n in lags])
    return a.agg(*[F.round(F.corr("sales", f"oil_lag_{n}"), 6).alias(f"corr_lag_{n}") for n in lags])


_IN_RANGE = """(SELECT h.* FROM holidays_events h
  WHERE h.date BETWEEN (SELECT MIN(date) FROM sales_raw) AND (SELECT MAX(date) FROM sales_raw))"""


def _in_range(spark, sf):
    r = fx.sales_raw(spark, sf).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    return fx.holidays_events(spark).where(F.col("date").between(r.select("a").scalar(), r.select("b").scalar()))


@register("holiday_text_flag", with_views(f"""
SELECT event_seq, description, CASE WHEN COALESCE(contains(lower(description), 'carnaval'), false) THEN 1 ELSE 0 END AS is_carnaval
FROM {_IN_RANGE}"""), ids="P-12")
def holiday_text_flag(spark, sf):
    return _in_range(spark, sf).select("event_seq", "description", hol.text_flag("description", "carnaval").alias("is_carnaval"))


@register("map_encode", with_views(f"""
SELECT event_seq, type, COALESCE(CASE type WHEN 'Holiday' THEN 1 WHEN 'Event' THEN 2 WHEN 'Additional' THEN 3
  WHEN 'Transfer' THEN 4 WHEN 'Bridge' THEN 5 WHEN 'Work Day' THEN 0 END, 0) AS type_code FROM {_IN_RANGE}"""), ids="P-13")
def map_encode(spark, sf):
    return _in_range(spark, sf).select("event_seq", "type", hol.map_code("type", hol.TYPE_CODES).cast("int").alias("type_code"))


# ---------------------------------------------------------------- the calendar where it holds: reports that grow with the sales

EXPOSED_SQL = """
WITH sd AS (SELECT store_nbr, date, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS sales, COUNT(*) AS n_rows FROM sales_raw GROUP BY 1, 2),
x AS (SELECT sd.store_nbr, sd.date, h.event_seq, h.type, h.locale, h.description, h.transferred, sd.sales, sd.n_rows
  FROM sd JOIN holidays_events h ON h.date = sd.date LEFT JOIN stores s ON s.store_nbr = sd.store_nbr
  WHERE h.locale = 'National' OR (h.locale = 'Regional' AND h.locale_name = s.state) OR (h.locale = 'Local' AND h.locale_name = s.city))
"""


def _exposed(spark, sf):
    return hol.exposure(fx.sales_raw(spark, sf), fx.stores(spark, sf), fx.holidays_events(spark))


def _frequency(df, by):
    """Store days, distinct days, sales and share of all store days per value, and whether it comes once only or is the most common."""
    g = df.groupBy(by).agg(F.count(F.lit(1)).alias("store_days"), F.count_distinct("date").alias("n_days"), exact_sum("sales").alias("sales"))
    total, top = (g.agg(f("store_days").alias("t")).select("t").scalar() for f in (F.sum, F.max))
    return g.select("*", F.round(100 * F.col("store_days") / total, 4).alias("pct"), (F.col("n_days") == 1).alias("single"), (F.col("store_days") == top).alias("most_common"))


def _frequency_sql(by):
    return with_views(EXPOSED_SQL.rstrip() + f""",
g AS (SELECT {by}, COUNT(*) AS store_days, COUNT(DISTINCT date) AS n_days, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS sales FROM x GROUP BY {by})
SELECT *, round(100 * store_days / (SELECT SUM(store_days) FROM g), 4) AS pct, n_days = 1 AS single, store_days = (SELECT max(store_days) FROM g) AS most_common FROM g""")


@register("event_type_exposure", _frequency_sql("type"), ids="A-15")
def event_type_exposure(spark, sf):
    return _frequency(_exposed(spark, sf), "type")


@register("locale_exposure", _frequency_sql("locale"), ids="A-15")
def locale_exposure(spark, sf):
    return _frequency(_exposed(spark, sf), "locale")


@register("holiday_exposure", with_views(EXPOSED_SQL.rstrip() + """
SELECT store_nbr, date, event_seq, CASE type WHEN 'Holiday' THEN 1 WHEN 'Event' THEN 2 WHEN 'Additional' THEN 3
    WHEN 'Transfer' THEN 4 WHEN 'Bridge' THEN 5 WHEN 'Work Day' THEN 0 ELSE 0 END AS type_code,
  CASE WHEN COALESCE(contains(lower(description), 'carnaval'), false) THEN 1 ELSE 0 END AS is_carnaval, n_rows, sales FROM x"""), ids="P-12, P-13")
def holiday_exposure(spark, sf):
    return _exposed(spark, sf).select("store_nbr", "date", "event_seq", hol.map_code("type", hol.TYPE_CODES).cast("int").alias("type_code"), hol.text_flag("description", "carnaval").alias("is_carnaval"), "n_rows", "sales")


@register("holiday_store_profile", with_views(EXPOSED_SQL.rstrip() + """,
d AS (SELECT store_nbr, date, COUNT(*) AS c FROM x GROUP BY 1, 2),
m AS (SELECT store_nbr, year(date) AS year, COUNT(*) AS event_days, COUNT(*) FILTER (WHERE c > 1) AS multi_event_days FROM d GROUP BY 1, 2)
SELECT x.store_nbr, year(x.date) AS year, COUNT(*) AS n_events, any_value(m.event_days) AS event_days, any_value(m.multi_event_days) AS multi_event_days,
  round(avg(CASE WHEN transferred THEN 1.0 ELSE 0.0 END), 6) AS transfer_share, round(avg(CASE WHEN locale = 'National' THEN 1.0 ELSE 0.0 END), 6) AS national_share
FROM x JOIN m ON m.store_nbr = x.store_nbr AND m.year = year(x.date) GROUP BY 1, 2"""), ids="A-16")
def holiday_store_profile(spark, sf):
    """Per store and year: entries that hold there on its days with sales, days with several, shares of transferred and of national ones."""
    day = _exposed(spark, sf).groupBy("store_nbr", F.year("date").alias("year"), "date").agg(
        F.count(F.lit(1)).alias("c"), F.count_if("transferred").alias("t"), F.count_if(F.col("locale") == "National").alias("n"))
    return day.groupBy("store_nbr", "year").agg(F.sum("c").alias("n_events"), F.count(F.lit(1)).alias("event_days"), F.count_if(F.col("c") > 1).alias("multi_event_days"),
                                                F.round(F.sum("t") / F.sum("c"), 6).alias("transfer_share"), F.round(F.sum("n") / F.sum("c"), 6).alias("national_share"))
