"""Flagship query: safe features -> split -> per-segment feature level and seasonal-naive metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.catalog.sqlparts import metrics_sql, rolling_sql, split_case
from shelfcast.operators.evaluate import metric_columns
from shelfcast.operators.joins import join_stores
from shelfcast.plans.features import add_safe_features, add_temporal_features
from shelfcast.plans.split import temporal_split
from shelfcast.registry import register
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views


def flagship(spark, sf):
    panel = fx.sales_panel(spark, sf)
    feats = add_safe_features(add_temporal_features(panel))
    feats = join_stores(feats, fx.stores(spark, sf), ["type"])
    sp = temporal_split(feats)
    return sp.groupBy("split", "type", "family").agg(
        F.round(F.avg("rolling_mean_28_safe"), 6).alias("mean_rolling_mean_28_safe"),
        F.round(F.avg("is_weekend"), 6).alias("weekend_share"),
        *metric_columns("sales", "lag_21"),
    )


FLAGSHIP_SQL = with_views(f"""
WITH f AS (
  SELECT p.date, p.family, p.sales, s.type,
         CASE WHEN isodow(p.date) >= 6 THEN 1 ELSE 0 END AS is_weekend,
         lag(p.sales, 21) OVER (PARTITION BY p.store_nbr, p.family ORDER BY p.date) AS lag_21,
         {rolling_sql('p.sales', 28, 16, 'mean', 1, 'p.store_nbr, p.family', 'p.date', exact=(4, 8))} AS rolling_mean_28_safe
  FROM sales_panel p LEFT JOIN stores s ON p.store_nbr = s.store_nbr
), sp AS (SELECT *, {split_case()} AS split FROM f)
SELECT split, type, family,
       round(avg(rolling_mean_28_safe), 6) AS mean_rolling_mean_28_safe,
       round(avg(is_weekend), 6) AS weekend_share,
       {metrics_sql('sales', 'lag_21')}
FROM sp WHERE split IS NOT NULL
GROUP BY split, type, family""")

register("flagship_safe_forecast", FLAGSHIP_SQL, ids="F-01, W-02, W-05, J-01, F-13, V-01, M-06 (seasonal naive)")(flagship)
