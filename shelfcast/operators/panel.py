"""Panel completion, calendar spines and gap filling.

A series is one value of `spec.keys`; the grid of a panel is every day between a
start and an end for every series. The grid is generated per series with
`explode(sequence(start, end))`, so it is partitioned by series and grows with
(#series x #days) only - there is no cross product of two large relations.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.spec import DEFAULT_PANEL, PanelSpec


def _as_date_col(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, (dt.date, str)):
        return F.to_date(F.lit(str(v)))
    raise TypeError(f"unsupported date bound {v!r}")


def date_bounds(df: DataFrame, date_col: str = "date") -> DataFrame:
    """One-row (start, end) of a date column; one row, whatever the input."""
    return df.agg(F.min(date_col).alias("_start"), F.max(date_col).alias("_end"))


def date_spine(df: DataFrame, date_col: str = "date", start=None, end=None) -> DataFrame:
    """Every calendar day from `start` (default min) to `end` (default max) of `df[date_col]`."""
    s, e = _bound_cols(df, date_col, start, end)
    return df.sparkSession.range(1).select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias(date_col))


def _bound_cols(df: DataFrame, date_col: str, start, end) -> tuple[Column, Column]:
    """Start/end as scalar subqueries (one merged 1-row aggregate), or given literals."""
    b = date_bounds(df, date_col)
    s = _as_date_col(start) if start is not None else b.select("_start").scalar()
    e = _as_date_col(end) if end is not None else b.select("_end").scalar()
    return s, e


def complete_panel(
    df: DataFrame,
    spec: PanelSpec = DEFAULT_PANEL,
    fill: dict[str, object] | None = None,
    flag_col: str | None = "is_imputed",
    start=None,
    end=None,
    series: DataFrame | None = None,
) -> DataFrame:
    """All days x all series, left join of `df`, constant fill, optional imputed flag.

    The global bounds are scalar subqueries (one 1-row aggregate); the distinct
    series table is expanded with a generator, then joined to the data on the grain.
    """
    keys = spec.key_cols
    d = spec.date
    series = series if series is not None else df.select(*keys).distinct()
    s, e = _bound_cols(df, d, start, end)
    grid = series.select(*keys, F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias(d))
    value_cols = [c for c in df.columns if c not in (d, *keys)]
    marked = df.withColumn("_present", F.lit(True)) if flag_col else df
    out = grid.join(marked, [d, *keys], "left")
    fill = fill or {}
    cols = [F.col(d), *[F.col(k) for k in keys]]
    for c in value_cols:
        cols.append(F.coalesce(F.col(c), F.lit(fill[c])).alias(c) if c in fill else F.col(c))
    if flag_col:
        cols.append(F.col("_present").isNull().cast("int").alias(flag_col))
    return out.select(*cols)


def _series_window(keys: list[str], order: str) -> Window:
    return Window.partitionBy(*keys).orderBy(order) if keys else Window.orderBy(order)


def ffill_bfill(df: DataFrame, cols: list[str], order: str = "date", keys: list[str] | None = None) -> DataFrame:
    """Forward fill, then backward fill the leading gap (per series when `keys`)."""
    keys = keys or []
    w = _series_window(keys, order)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = df
    for c in cols:
        out = out.withColumn(c, F.coalesce(F.last(c, True).over(back), F.first(c, True).over(fwd)))
    return out


def interpolate_linear(df: DataFrame, col: str, date_col: str = "date", keys: list[str] | None = None,
                       out_col: str | None = None) -> DataFrame:
    """Linear interpolation in time between the previous and next known values.

    Gaps before the first / after the last known value hold the nearest known
    value (interpolation in both directions). Days are the distance unit.
    """
    keys = keys or []
    out_col = out_col or col
    w = _series_window(keys, date_col)
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = w.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    known_day = F.when(F.col(col).isNotNull(), F.col(date_col))
    prev_v, prev_d = F.last(col, True).over(back), F.last(known_day, True).over(back)
    next_v, next_d = F.first(col, True).over(fwd), F.first(known_day, True).over(fwd)
    span = F.datediff(next_d, prev_d)
    frac = F.try_divide(F.datediff(F.col(date_col), prev_d).cast("double"), span.cast("double"))
    inner = prev_v + (next_v - prev_v) * F.coalesce(frac, F.lit(0.0))
    value = F.when(F.col(col).isNotNull(), F.col(col)).otherwise(F.coalesce(inner, prev_v, next_v))
    return df.withColumn(out_col, value)
