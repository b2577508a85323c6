"""Aggregation operators (A-01..A-31): one-pass grouped statistics, shares and rankings.

Statistics over the fact are computed with partial (map-side) aggregation; cumulative
shares, ranks and ratios run only over the aggregated rows (one per store / family /
day), never over the fact itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.numeric import EPS, exact_sum
from shelfcast.operators.ranks import running


def group_stats(df: DataFrame, by, value: str, digits: int = 6, median: bool = False) -> DataFrame:
    """sum, mean, std (n-1), min, max, count, zero count / share [, median] per group."""
    by = [by] if isinstance(by, str) else list(by)
    x = F.col(value)
    aggs = [exact_sum(x).alias("total"), F.round(F.avg(x), digits).alias("mean"),
            F.round(F.stddev_samp(x), digits).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
            F.count(x).alias("n"), F.count_if(x == 0).alias("zero_count"),
            F.round(F.avg((x == 0).cast("double")), digits).alias("zero_share")]
    if median:
        aggs.append(F.round(F.percentile(x, 0.5), digits).alias("median"))
    return df.groupBy(*by).agg(*aggs)


def shares(df: DataFrame, key, value: str, digits: int = 9) -> DataFrame:
    """Share of total, rank (desc, key tie-break) and cumulative share over aggregated rows (A-06, W-13)."""
    keys = [key] if isinstance(key, str) else list(key)
    total = df.agg(exact_sum(value)).scalar()
    s = running(df.select(*keys, value), [F.col(value).desc(), *keys], {"_cum": value}, "_pos")
    return s.select(*keys, value, F.round(F.try_divide(F.col(value), total), digits).alias("share"),
                    (F.col("_pos") + 1).cast("int").alias("rank"), F.round(F.try_divide(F.col("_cum"), total), digits).alias("cum_share"))


def concentration(df: DataFrame, key, value: str, digits: int = 9) -> DataFrame:
    """Totals per key -> share, rank, cumulative share, top-5/top-10 share and max/min ratio."""
    keys = [key] if isinstance(key, str) else list(key)
    s = shares(df.groupBy(*keys).agg(exact_sum(value).alias("total")), keys, "total", digits)
    top = lambda n: exact_sum(F.when(F.col("rank") <= n, F.col("total")))
    whole = s.agg(F.round(F.try_divide(top(5), exact_sum("total")), digits).alias("top5_share"), F.round(F.try_divide(top(10), exact_sum("total")), digits).alias("top10_share"),
                  F.round(F.try_divide(F.max("total"), F.min("total")), digits).alias("max_min_ratio"))
    return s.select("*", *(whole.select(c).scalar().alias(c) for c in whole.columns))


def cv(std: Column, mean: Column) -> Column:
    """Coefficient of variation with the reference's 1e-9 guard."""
    return std / (mean + F.lit(EPS))
