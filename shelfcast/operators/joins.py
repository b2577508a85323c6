"""Joins of the fact to its dimensions, membership joins and the holiday as-of halo.

No join carries a broadcast hint: Spark broadcasts a side whose statistics, or whose size at
run time (AQE), are below its threshold, and splits skewed shuffle joins otherwise. Key
uniqueness (no fan-out) is a separate data-quality query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Left join of a dimension; the planner and AQE broadcast it if it turns out small."""
    return fact.join(dim, on, how)


def join_stores(fact: DataFrame, stores: DataFrame, cols=None) -> DataFrame:
    cols = cols or [c for c in stores.columns if c != "store_nbr"]
    return dim_join(fact, stores.select("store_nbr", *cols), "store_nbr")


def duplicate_keys(dim: DataFrame, keys) -> DataFrame:
    """Keys that occur more than once (must be empty before a fan-out-free join)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return dim.groupBy(*keys).count().filter("count > 1")


def semi_join(df: DataFrame, members: DataFrame, on) -> DataFrame:
    return df.join(members, on, "left_semi")


def anti_join(df: DataFrame, excluded: DataFrame, on) -> DataFrame:
    return df.join(excluded, on, "left_anti")


def shifted_join(hist: DataFrame, target: DataFrame, n: int, value: str, keys, date: str = "date",
                 out_col: str | None = None) -> DataFrame:
    """Calendar lag by self-join: the value of day d - n joined onto day d."""
    out_col = out_col or f"lag_{n}"
    src = hist.select(*keys, F.date_add(F.col(date), n).alias(date), F.col(value).alias(out_col))
    return target.join(src, [date, *keys], "left")


def nearest_event_distance(dates: DataFrame, events: DataFrame, date: str = "date") -> DataFrame:
    """Days to the next event strictly after, and since the last strictly before (-1 if none).

    Works on distinct dates only (a few thousand rows): union the event days with the
    fact days, take `min/max ... ignore nulls` over the date order, join back by date.
    """
    ev = events.select(F.col(date).alias(date)).distinct().withColumn("_ev", F.lit(True))
    d = dates.select(date).distinct()
    allv = d.join(ev, date, "full")
    w = Window.orderBy(date)
    nxt = F.min(F.when(F.col("_ev"), F.col(date))).over(w.rowsBetween(1, Window.unboundedFollowing))
    prv = F.max(F.when(F.col("_ev"), F.col(date))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    out = allv.select(
        date,
        F.coalesce(F.datediff(nxt, F.col(date)), F.lit(-1)).alias("days_to_next_holiday"),
        F.coalesce(F.datediff(F.col(date), prv), F.lit(-1)).alias("days_after_last_holiday"),
    )
    return out.join(d, date, "left_semi")
