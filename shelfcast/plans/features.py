"""Feature blocks of the panel (F-01..F-03, F-06) and their column registries."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfcast.functions.calendar import TEMPORAL_FEATURES, temporal_columns
from shelfcast.operators.windows import ROWS, add_rolling, lag_col, rolling_col
from shelfcast.spec import DEFAULT_PANEL, PanelSpec

# Lag offsets and rolling windows of the two feature generations.
LAGS = [1, 2, 3, 7, 14, 28, 364]
ROLLING_SHIFT1 = {  # out_col -> (window, offset, stat, min_periods)
    "rolling_mean_7": (7, 1, "mean", 1),
    "rolling_mean_14": (14, 1, "mean", 1),
    "rolling_mean_28": (28, 1, "mean", 1),
    "rolling_std_7": (7, 1, "std", 2),
}
SAFE_LAGS = [16, 21, 35]
ROLLING_SAFE = {
    "rolling_mean_30": (30, 16, "mean", 1),
    "rolling_mean_28_safe": (28, 16, "mean", 1),
    "rolling_std_28_safe": (28, 16, "std", 2),
}
# Features removed in the safe set (shorter than the 16-day horizon, or shift-1 rolling).
TOXIC_FEATURES = ["lag_1", "lag_2", "lag_3", "lag_7", "rolling_mean_7", "rolling_mean_14",
                  "rolling_mean_28", "rolling_std_7"]
LAG_FEATURES = [f"lag_{n}" for n in LAGS] + list(ROLLING_SHIFT1)
SAFE_FEATURES = [f"lag_{n}" for n in SAFE_LAGS] + list(ROLLING_SAFE)


def add_temporal_features(df: DataFrame, date: str = "date") -> DataFrame:
    return df.select("*", *temporal_columns(date))


def add_lag_features(df: DataFrame, spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS,
                     lags=None, rolling=None) -> DataFrame:
    """Lags 1..364 and shift-1 rolling mean/std per series, in one window pass."""
    lags = LAGS if lags is None else lags
    rolling = ROLLING_SHIFT1 if rolling is None else rolling
    t = spec.target
    cols = [lag_col(t, n, spec, mode).alias(f"lag_{n}") for n in lags]
    cols += [rolling_col(t, w, o, s, m, spec, mode).alias(k) for k, (w, o, s, m) in rolling.items()]
    return df.select("*", *cols)


def add_safe_features(df: DataFrame, spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> DataFrame:
    """Lags >= 16 and rolling statistics ending 16 days back: safe for a 16-day direct forecast."""
    return add_lag_features(df, spec, mode, lags=SAFE_LAGS, rolling=ROLLING_SAFE)


def build_features(df: DataFrame, spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> DataFrame:
    return add_lag_features(add_temporal_features(df, spec.date), spec, mode)


__all__ = ["TEMPORAL_FEATURES", "add_temporal_features", "add_lag_features", "add_safe_features",
           "build_features", "add_rolling"]
