"""Rolling-origin queries (M-06, V-02..V-04): models without a fit against DuckDB, fitted models on the same reports."""

from __future__ import annotations

from shelfcast.catalog.models import FEATURES, WEIGHTS, model_table
from shelfcast.catalog.sqlparts import exact_mean_sql, metrics_sql
from shelfcast.operators import backtest as bt
from shelfcast.operators import models as mdl
from shelfcast.registry import register
from shelfcast.session import materialize
from shelfcast.sources import fixtures as fx
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import DEFAULT_SPLIT

KEYS = ["store_nbr", "family"]
TEST_DAYS = (DEFAULT_SPLIT.test[1] - DEFAULT_SPLIT.test[0]).days + 1
STARTS = bt.origins(DEFAULT_SPLIT.test[0], 4, 28)
SIMPLE = ["seasonal_naive", "mean"]

_ORIGINS = "(VALUES " + ", ".join(f"(DATE '{o}')" for o in STARTS) + ") AS t(origin)"
PREDICTED_SQL = f"""
WITH o AS (SELECT origin FROM {_ORIGINS}),
r AS (SELECT p.store_nbr, p.family, p.date, p.sales AS actual, o.origin, p.date - o.origin AS h
  FROM sales_panel p JOIN o ON p.date - o.origin BETWEEN -28 AND {TEST_DAYS - 1}),
mm AS (SELECT store_nbr, family, origin, {exact_mean_sql('actual', '', 4, 6)} AS mean FROM r WHERE h < 0 GROUP BY ALL),
w AS (SELECT a.store_nbr, a.family, a.origin, a.date, a.actual, n.actual AS naive, mm.mean
  FROM r a LEFT JOIN r n ON n.store_nbr = a.store_nbr AND n.family = a.family AND n.origin = a.origin AND n.h = a.h % 7 - 7
  LEFT JOIN mm ON mm.store_nbr = a.store_nbr AND mm.family = a.family AND mm.origin = a.origin WHERE a.h >= 0),
pr AS (SELECT store_nbr, family, origin, date, 'seasonal_naive' AS model, CAST(NULL AS VARCHAR) AS detail, actual, naive AS predicted FROM w
  UNION ALL SELECT store_nbr, family, origin, date, 'mean', NULL, actual, mean FROM w)
"""


def comparison_sql(models: list[str]) -> str:
    """`comparison` over the relations pr (predictions) and td (store_nbr, family, origin, train_days)."""
    error = lambda m: f"round(sqrt(avg(power(ln(1 + greatest(predicted, 0.0)) - ln(1 + greatest(actual, 0.0)), 2)) FILTER (WHERE model = '{m}' AND predicted IS NOT NULL AND actual IS NOT NULL)), 6) AS rmsle_{m}"
    failed = lambda m: f"COUNT(*) FILTER (WHERE model = '{m}' AND predicted IS NULL) AS failed_{m}"
    least = "least(" + ", ".join(f"rmsle_{m}" for m in models) + ")"
    best = "CASE " + " ".join(f"WHEN rmsle_{m} = {least} THEN '{m}'" for m in models) + " END AS best"
    return f"""c AS (SELECT store_nbr, family, origin, COUNT(DISTINCT date) AS val_days, max(detail) AS "order", {", ".join(map(error, models))}, {", ".join(map(failed, models))}
  FROM pr GROUP BY store_nbr, family, origin),
cm AS (SELECT c.*, td.train_days, {best} FROM c JOIN td ON td.store_nbr = c.store_nbr AND td.family = c.family AND td.origin = c.origin)
"""


_TD = "td AS (SELECT p.store_nbr, p.family, o.origin, COUNT(*) FILTER (WHERE p.date < o.origin) AS train_days FROM sales_panel p CROSS JOIN o GROUP BY ALL),\n"
_COMPARED = PREDICTED_SQL.rstrip() + ",\n" + _TD + comparison_sql(SIMPLE)


def simple(spark, sf):
    return bt.simple_forecasts(fx.sales_panel(spark, sf), KEYS, STARTS, TEST_DAYS, decimals=4)


def _compared(spark, sf):
    return bt.comparison(simple(spark, sf), bt.history_days(fx.sales_panel(spark, sf), KEYS, STARTS), KEYS, SIMPLE)


@register("backtest_predictions", with_views(PREDICTED_SQL + "SELECT * FROM pr"), ids="M-06, V-04")
def backtest_predictions(spark, sf):
    return simple(spark, sf)


@register("backtest_scores", with_views(PREDICTED_SQL + f"""
SELECT origin, model, {metrics_sql('actual', 'predicted')}, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE predicted IS NULL) AS failed FROM pr GROUP BY origin, model"""), ids="V-01, V-02")
def backtest_scores(spark, sf):
    return bt.scores(simple(spark, sf), ["origin"])


@register("backtest_comparison", with_views(_COMPARED + "SELECT * FROM cm"), ids="V-04")
def backtest_comparison(spark, sf):
    return _compared(spark, sf)


@register("backtest_wins", with_views(_COMPARED + """
, per AS (SELECT origin, 'seasonal_naive' AS model, COUNT(*) FILTER (WHERE best = 'seasonal_naive') AS w, avg(rmsle_seasonal_naive) AS a, SUM(rmsle_seasonal_naive) AS s, COUNT(rmsle_seasonal_naive) AS n, SUM(failed_seasonal_naive) AS f FROM cm GROUP BY origin
  UNION ALL SELECT origin, 'mean', COUNT(*) FILTER (WHERE best = 'mean'), avg(rmsle_mean), SUM(rmsle_mean), COUNT(rmsle_mean), SUM(failed_mean) FROM cm GROUP BY origin)
SELECT model, CAST(SUM(w) AS BIGINT) AS wins, round(SUM(s) / SUM(n), 6) AS mean_rmsle, round(max(a) - min(a), 6) AS spread, CAST(SUM(f) AS BIGINT) AS failed FROM per GROUP BY model""".replace("\n, per AS", ",\nper AS", 1)), ids="V-04")
def backtest_wins(spark, sf):
    return bt.wins(_compared(spark, sf), SIMPLE)


FITTED = ["boosters", "arima", *SIMPLE]


def fitted_predictions(spark, sf, count: int = 2, rounds: int = 5):
    """Predictions of the blended boosters, the seasonal ARIMA and the models without a fit from the last `count` origins, stored."""
    starts, panel = STARTS[-count:], fx.sales_panel(spark, sf)
    boosters = bt.booster_forecasts(model_table(spark, sf), KEYS, starts, TEST_DAYS, FEATURES, list(zip((mdl.LGB_TUNED, mdl.XGB_TUNED), WEIGHTS)), rounds,
                                    lags={"lag_14": 14}, encoded=("store_family", "store_family_te"))
    both = boosters.unionByName(bt.arima_forecasts(panel, KEYS, starts, TEST_DAYS)).unionByName(bt.simple_forecasts(panel, KEYS, starts, TEST_DAYS, decimals=4))
    return materialize(both, "backtest")


@register("backtest_fitted", None, ids="M-05, M-06, V-03, V-04")
def backtest_fitted(spark, sf):
    """All series at the last two origins: boosters (of few rounds), ARIMA and the models without a fit, side by side."""
    days = bt.history_days(fx.sales_panel(spark, sf), KEYS, STARTS[-2:])
    return bt.comparison(fitted_predictions(spark, sf), days, KEYS, FITTED)
