"""Scans, fixture panels, predicates and distinct values (S-02, S-03, C-09, C-10, C-21, P-15, U-04)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.numeric import exact_sum
from shelfcast.operators.panel import complete_panel
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import DEFAULT_SPLIT, PanelSpec


@register("scan_dates", with_views("SELECT * FROM sales_raw"), ids="S-02")
def scan_dates(spark, sf):
    return fx.sales_raw(spark, sf)


@register("scan_pruned", with_views("SELECT date, store_nbr, family, sales FROM sales_panel"), ids="S-03")
def scan_pruned(spark, sf):
    return fx.sales_panel(spark, sf).select("date", "store_nbr", "family", "sales")


@register("panel_transactions", with_views("""
SELECT CAST(g.d AS DATE) AS date, k.store_nbr, COALESCE(t.transactions, 0) AS transactions,
       CASE WHEN t.store_nbr IS NULL THEN 1 ELSE 0 END AS is_imputed
FROM (SELECT DISTINCT store_nbr FROM transactions) k
CROSS JOIN (SELECT MIN(date) d0, MAX(date) d1 FROM transactions) b
CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
LEFT JOIN transactions t ON t.store_nbr = k.store_nbr AND t.date = CAST(g.d AS DATE)"""), ids="C-09, J-09")
def panel_transactions(spark, sf):
    return complete_panel(fx.transactions(spark, sf), PanelSpec(keys=("store_nbr",), target="transactions"),
                          fill={"transactions": 0}, flag_col="is_imputed")


@register("panel_family_day", with_views("""
WITH fd AS (SELECT date, family, CAST(SUM(CAST(sales AS DECIMAL(38,6))) AS DOUBLE) AS sales FROM sales_raw GROUP BY 1, 2)
SELECT CAST(g.d AS DATE) AS date, k.family, COALESCE(fd.sales, 0.0) AS sales,
       CASE WHEN fd.family IS NULL THEN 1 ELSE 0 END AS is_imputed
FROM (SELECT DISTINCT family FROM fd) k
CROSS JOIN (SELECT MIN(date) d0, MAX(date) d1 FROM fd) b
CROSS JOIN LATERAL unnest(generate_series(b.d0, b.d1, INTERVAL 1 DAY)) AS g(d)
LEFT JOIN fd ON fd.family = k.family AND fd.date = CAST(g.d AS DATE)"""), ids="C-10")
def panel_family_day(spark, sf):
    fd = fx.sales_raw(spark, sf).groupBy("date", "family").agg(exact_sum("sales").alias("sales"))
    return complete_panel(fd, PanelSpec(keys=("family",)), fill={"sales": 0.0}, flag_col="is_imputed")


@register("distinct_counts", with_views("""
SELECT (SELECT COUNT(DISTINCT store_nbr) FROM sales_panel) AS n_stores,
       (SELECT COUNT(DISTINCT family) FROM sales_panel) AS n_families,
       (SELECT COUNT(DISTINCT date) FROM sales_panel) AS n_days,
       (SELECT COUNT(DISTINCT city) FROM stores) AS n_cities,
       (SELECT COUNT(DISTINCT state) FROM stores) AS n_states,
       (SELECT COUNT(DISTINCT cluster) FROM stores) AS n_clusters"""), ids="C-21")
def distinct_counts(spark, sf):
    p = fx.sales_panel(spark, sf)
    s = fx.stores(spark, sf)
    a = p.agg(F.countDistinct("store_nbr").alias("n_stores"), F.countDistinct("family").alias("n_families"),
              F.countDistinct("date").alias("n_days"))
    b = s.agg(F.countDistinct("city").alias("n_cities"), F.countDistinct("state").alias("n_states"),
              F.countDistinct("cluster").alias("n_clusters"))
    return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])


_V0, _V1 = DEFAULT_SPLIT.val


@register("filter_window", with_views(f"""
SELECT date, store_nbr, family, sales FROM sales_panel
WHERE date BETWEEN DATE '{_V0}' AND DATE '{_V1}'"""), ids="P-15")
def filter_window(spark, sf):
    p = fx.sales_panel(spark, sf)
    return p.filter(F.col("date").between(F.lit(_V0), F.lit(_V1))).select("date", "store_nbr", "family", "sales")


@register("distinct_dates", with_views("SELECT DISTINCT date FROM sales_raw"), ids="U-04")
def distinct_dates(spark, sf):
    return fx.sales_raw(spark, sf).select("date").distinct()
