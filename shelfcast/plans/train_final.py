"""The full feature table (F-11), the v3 safe feature set (F-06) and the direct horizon features (F-07).

One lazy plan: the series windows share one Exchange + Sort on the series keys;
every dimension (stores, holiday match tables, the daily oil table, the per-fold
encoder table) is small and bounded by its own grain; AQE broadcasts it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.calendar import TEMPORAL_FEATURES
from shelfcast.operators.encoders import contiguous_fold, row_position, target_encode_apply, target_encode_fit, target_encode_oof
from shelfcast.operators.recent import lag_at, recent_days, rolling_at
from shelfcast.operators.windows import CALENDAR, ROWS
from shelfcast.plans.external import OIL_FEATURES, STORE_FEATURES, add_oil_features, add_store_features
from shelfcast.plans.features import (LAG_FEATURES, ROLLING_SAFE, SAFE_FEATURES, SAFE_LAGS, TOXIC_FEATURES,
                                      add_lag_features, add_temporal_features)
from shelfcast.plans.holidays import HOLIDAY_FEATURES, add_holiday_features
from shelfcast.spec import DEFAULT_PANEL, DEFAULT_SPLIT, HORIZON_DAYS, PanelSpec, SplitSpec

BASE_COLS = ["id", "date", "store_nbr", "family", "sales", "onpromotion"]
TE_COLS = ["store_family", "store_family_te"]
TRAIN_FINAL_COLS = BASE_COLS + TEMPORAL_FEATURES + LAG_FEATURES + HOLIDAY_FEATURES + OIL_FEATURES + STORE_FEATURES + TE_COLS
SPLIT_FEATURE_COLS = [c for c in TRAIN_FINAL_COLS if c not in ("id", "sales")]
V3_FEATURE_COLS = [c for c in SPLIT_FEATURE_COLS if c not in TOXIC_FEATURES] + SAFE_FEATURES


def store_family(spec: PanelSpec = DEFAULT_PANEL):
    return F.concat_ws("_", *[F.col(k).cast("string") for k in spec.keys])


def build_train_final(panel: DataFrame, stores: DataFrame, holidays: DataFrame, oil: DataFrame,
                      spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS, folds: int = 5,
                      freq_base: str = "rows") -> DataFrame:
    """51-column training table in registry order.

    `id` is the 0-based position in (date, keys) order; the out-of-fold target
    encoding uses contiguous folds along that same order.
    """
    order = [spec.date, *spec.keys]
    base = row_position(panel, order, "id")  # stored: the bounds and the encoder's sums read it, not the sources
    base = base.withColumn("store_family", store_family(spec))
    bounds = base.agg(F.count(F.lit(1)).alias("n"), F.max(spec.date).alias("end"))
    base = base.withColumn("_fold", contiguous_fold(F.col("id"), bounds.select("n").scalar(), folds))
    f = add_temporal_features(base, spec.date)
    f = add_lag_features(f, spec, mode)
    f = add_holiday_features(f, stores, holidays, dates=base.select(spec.date))
    f = add_oil_features(f, oil, end=bounds.select("end").scalar())
    f = add_store_features(f, stores, freq_base, count_base=base)
    f = target_encode_oof(f, "store_family", spec.target, "_fold", "store_family_te", stats_on=base)
    return f.select(*TRAIN_FINAL_COLS)


def add_v3_features(train_final: DataFrame, spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> DataFrame:
    """Drop the 8 short-horizon features, add the 6 safe ones (computed on the whole history)."""
    f = add_lag_features(train_final, spec, mode, lags=SAFE_LAGS, rolling=ROLLING_SAFE)
    return f.drop(*TOXIC_FEATURES)


def safe_feature_set(train_final: DataFrame, split: SplitSpec = DEFAULT_SPLIT, spec: PanelSpec = DEFAULT_PANEL,
                     mode: str = ROWS) -> DataFrame:
    """47 features + split label + targets (`sales`, `sales_log = log1p(sales)`)."""
    from shelfcast.plans.split import temporal_split

    f = temporal_split(add_v3_features(train_final, spec, mode), spec.date, split)
    return f.select(*V3_FEATURE_COLS, "split", "sales", F.log1p("sales").alias("sales_log"))


def rounded_log_target(df: DataFrame, digits: int = 9) -> DataFrame:
    return df.withColumn("sales_log", F.round("sales_log", digits))


def horizon_frame(history: DataFrame, start: dt.date, days: int = HORIZON_DAYS,
                  spec: PanelSpec = DEFAULT_PANEL) -> DataFrame:
    """Future rows (target NULL) for every series of `history`: series x [start, start+days)."""
    series = history.select(*spec.keys).distinct()
    end = start + dt.timedelta(days=days - 1)
    return series.select(*spec.keys, F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("INTERVAL 1 DAY"))).alias(spec.date))


def build_horizon_features(history: DataFrame, stores: DataFrame, holidays: DataFrame, oil: DataFrame,
                           start: dt.date, days: int = HORIZON_DAYS, spec: PanelSpec = DEFAULT_PANEL,
                           lookback: int = 364, future: DataFrame | None = None, mode: str = CALENDAR,
                           freq_base: str = "stores") -> DataFrame:
    """Direct-forecast features for the horizon rows (47 v3 features).

    `future`: the rows to forecast (date, keys, onpromotion, and any other columns, such as
    an id, which are kept); without it, every series for `days` days without promotion.
    Calendar lags and rolling values are places in one array per series of the last `lookback`
    days (the longest lag), which the future rows look up. In rows mode, the history of those
    days is unioned with the future rows, as row lags count both, and windows run over it.
    `freq_base` as in `build_train_final`, counted over the
    history; the target encoding is fitted on the whole history.
    """
    if future is None:
        future = horizon_frame(history, start, days, spec).withColumn("onpromotion", F.lit(0.0))
    extra = [c for c in future.columns if c not in (*spec.grain, "onpromotion", spec.target)]
    lag_only = [int(c.split("_")[1]) for c in LAG_FEATURES if c.startswith("lag_") and c not in TOXIC_FEATURES]
    lags = sorted(set(lag_only) | set(SAFE_LAGS))
    if mode == CALENDAR:
        state = recent_days(history, start, lookback, spec)
        ahead = F.datediff(F.col(spec.date), F.lit(start))
        f = add_temporal_features(future.drop(spec.target), spec.date).join(state, list(spec.keys), "left")
        f = f.select("*", *(lag_at("recent", ahead, n).alias(f"lag_{n}") for n in lags),
                     *(rolling_at("recent", ahead, w, o, s, m, spec.decimals).alias(k) for k, (w, o, s, m) in ROLLING_SAFE.items())).drop("recent")
    else:  # row lags count the rows of history and horizon together
        cut = start - dt.timedelta(days=lookback)
        hist = history.filter((F.col(spec.date) >= F.lit(cut)) & (F.col(spec.date) < F.lit(start))).select(
            spec.date, *spec.keys, spec.target, "onpromotion")
        fut = future.select(*spec.grain, F.lit(None).cast("double").alias(spec.target), "onpromotion", *extra)
        f = add_temporal_features(hist.unionByName(fut, allowMissingColumns=True), spec.date)
        f = add_lag_features(f, spec, mode, lags=lags, rolling=ROLLING_SAFE).filter(F.col(spec.date) >= F.lit(start))
    f = add_holiday_features(f, stores, holidays, dates=future.select(spec.date))
    f = add_oil_features(f, oil, end=F.lit(start + dt.timedelta(days=days - 1)))
    f = add_store_features(f, stores, freq_base, count_base=history)
    hs = history.withColumn("store_family", store_family(spec))
    m = target_encode_fit(hs, "store_family", spec.target)
    f = target_encode_apply(f.withColumn("store_family", store_family(spec)), m, "store_family", "store_family_te")
    return f.select(*extra, *V3_FEATURE_COLS)
