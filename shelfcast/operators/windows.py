"""Per-series windows: lags (row or calendar), offset rolling statistics, differences.

Every window here shares one spec, `partitionBy(keys).orderBy(date)`, so a whole
feature block costs one Exchange (hash on the series keys) and one Sort; Catalyst
collapses the window operators. Calendar-mode frames order by the day number and
use RANGE offsets, so a missing day is a missing value, not a shifted row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.calendar import day_number
from shelfcast.functions.numeric import decimal_mean
from shelfcast.spec import DEFAULT_PANEL, PanelSpec

ROWS, CALENDAR = "rows", "calendar"


def series_window(spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> Window:
    order = F.col(spec.date) if mode == ROWS else day_number(spec.date)
    return Window.partitionBy(*spec.key_cols).orderBy(order) if spec.keys else Window.orderBy(order)


def _frame(w: Window, mode: str, lo: int, hi: int) -> Window:
    return w.rowsBetween(lo, hi) if mode == ROWS else w.rangeBetween(lo, hi)


def lag_col(value: str, n: int, spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> Column:
    """Value n rows back (rows) or exactly n days back (calendar); NULL when absent."""
    w = series_window(spec, mode)
    if mode == ROWS:
        return F.lag(value, n).over(w)
    return F.first(value).over(_frame(w, mode, -n, -n))


def add_lags(df: DataFrame, lags, value: str | None = None, spec: PanelSpec = DEFAULT_PANEL,
             mode: str = ROWS, prefix: str = "lag_") -> DataFrame:
    value = value or spec.target
    return df.select("*", *[lag_col(value, n, spec, mode).alias(f"{prefix}{n}") for n in lags])


def rolling_col(value: str, window: int, offset: int = 1, stat: str = "mean", min_periods: int = 1,
                spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> Column:
    """Statistic over the `window` values ending `offset` steps before the current one.

    Matches `shift(offset).rolling(window, min_periods)` per series: NULL unless at
    least `min_periods` non-null values are in the frame. `std` is the sample form.
    """
    f = _frame(series_window(spec, mode), mode, -(offset + window - 1), -offset)
    if stat == "mean" and spec.decimals is not None and value == spec.target:
        # exact decimal mean (scale + 4 digits, half-up), returned as double
        agg = decimal_mean(value, f, spec.decimals).cast("double")
    else:
        agg = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "min": F.min, "max": F.max}[stat](value).over(f)
    return F.when(F.count(value).over(f) >= min_periods, agg)


def add_rolling(df: DataFrame, specs: dict[str, tuple], value: str | None = None,
                spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> DataFrame:
    """specs: out_col -> (window, offset, stat, min_periods)."""
    value = value or spec.target
    cols = [rolling_col(value, w, o, s, m, spec, mode).alias(name) for name, (w, o, s, m) in specs.items()]
    return df.select("*", *cols)


def pct_change(value: str, n: int, spec: PanelSpec = DEFAULT_PANEL, mode: str = ROWS) -> Column:
    """x / x[n back] - 1; NULL when the earlier value is missing or 0."""
    return F.try_divide(F.col(value), lag_col(value, n, spec, mode)) - F.lit(1)


def add_difference(df: DataFrame, value: str, order: int = 1, spec: PanelSpec = DEFAULT_PANEL,
                   out_col: str | None = None, drop_null: bool = True) -> DataFrame:
    """d-th difference x - lag(x) per series (d applications); leading rows dropped."""
    out_col = out_col or f"{value}_diff{order}"
    w = series_window(spec)
    out = df
    tmp = value
    for i in range(order):
        name = out_col if i == order - 1 else f"_d{i + 1}"
        out = out.withColumn(name, F.col(tmp) - F.lag(tmp, 1).over(w))
        tmp = name
    out = out.drop(*[f"_d{i + 1}" for i in range(order - 1)])
    return out.filter(F.col(out_col).isNotNull()) if drop_null else out
