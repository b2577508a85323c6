"""Forecast evaluation (V-01..V-04): metrics in one aggregate pass, per any grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def metric_columns(actual: str = "actual", pred: str = "predicted", digits: int | None = 6) -> list[Column]:
    """RMSLE, RMSE, MAE (original units, both clipped at 0) and RMSE on the log scale.

    Rows where the prediction or the actual is NULL are skipped, so the columns can
    sit next to other aggregates in one pass.
    """
    ok = F.col(pred).isNotNull() & F.col(actual).isNotNull()
    y = F.when(ok, F.greatest(F.col(actual), F.lit(0.0)))
    p = F.when(ok, F.greatest(F.col(pred), F.lit(0.0)))
    ly, lp = F.log1p(y), F.log1p(p)
    vals = {
        "rmsle": F.sqrt(F.avg((lp - ly) * (lp - ly))),
        "rmse": F.sqrt(F.avg((p - y) * (p - y))),
        "mae": F.avg(F.abs(p - y)),
        "rmse_log": F.sqrt(F.avg((lp - ly) * (lp - ly))),
        "n": F.count(p),
    }
    out = []
    for k, v in vals.items():
        out.append((F.round(v, digits) if digits is not None and k != "n" else v).alias(k))
    return out


def regression_metrics(df: DataFrame, actual: str = "actual", pred: str = "predicted", by=None,
                       digits: int | None = 6) -> DataFrame:
    """One row per group (or one row) with rmsle, rmse, mae, rmse_log, n; rows with a NULL prediction are skipped."""
    by = by or []
    cols = metric_columns(actual, pred, digits)
    return df.groupBy(*by).agg(*cols) if by else df.agg(*cols)


def metrics_gap(metrics: DataFrame, model_col: str = "model", base: str = "baseline", other: str = "tuned",
                split_col: str = "split") -> DataFrame:
    """Baseline vs other model per split, with the difference of each metric (other - base)."""
    a = metrics.filter(F.col(model_col) == base).alias("a")
    b = metrics.filter(F.col(model_col) == other).alias("b")
    j = a.join(b, split_col)
    cols = [F.col(split_col)]
    for m in ("rmsle", "rmse", "mae", "rmse_log"):
        cols += [F.col(f"a.{m}").alias(f"{m}_{base}"), F.col(f"b.{m}").alias(f"{m}_{other}"),
                 F.round(F.col(f"b.{m}") - F.col(f"a.{m}"), 6).alias(f"{m}_gap")]
    return j.select(*cols)
