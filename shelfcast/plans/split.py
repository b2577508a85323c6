"""Temporal split (F-13) and its leakage check (C-14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.spec import DEFAULT_SPLIT, SplitSpec


def split_label(date: str | Column = "date", split: SplitSpec = DEFAULT_SPLIT) -> Column:
    d = F.col(date) if isinstance(date, str) else date
    expr = None
    for name, a, b in split.ranges():
        cond = d.between(F.lit(a), F.lit(b))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def temporal_split(df: DataFrame, date: str = "date", split: SplitSpec = DEFAULT_SPLIT,
                   keep_unassigned: bool = False) -> DataFrame:
    """Adds `split` (train/val/test[/horizon]); rows outside every range are dropped."""
    out = df.withColumn("split", split_label(date, split))
    return out if keep_unassigned else out.filter(F.col("split").isNotNull())


def split_bounds(df: DataFrame, date: str = "date", split: SplitSpec = DEFAULT_SPLIT) -> DataFrame:
    """Actual min/max date per split against its declared range; `ok` must be true everywhere."""
    spec = df.sparkSession.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("split"), F.lit(a).alias("range_start"), F.lit(b).alias("range_end"))
        for n, a, b in split.ranges()])))
    act = df.groupBy("split").agg(F.min(date).alias("min_date"), F.max(date).alias("max_date"),
                                  F.count(F.lit(1)).alias("n_rows"))
    return act.join(spec, "split").withColumn(
        "ok", (F.col("min_date") >= F.col("range_start")) & (F.col("max_date") <= F.col("range_end")))
