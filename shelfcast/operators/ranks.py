"""Positions, running sums and ranks over a total order of any size, in two levels.

The rows are range-partitioned and sorted, so that a task holds a contiguous part of the order.
Running values start anew in every part; what lies before a part comes from the sums of the
parts (one row for each). The sorted rows are written once, so that both levels see the same
parts. No task, and no window, holds more than a part.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import materialize

_MONEY = "decimal(38,6)"


def running(df: DataFrame, order: list, sums: dict[str, str] | None = None, position: str = "row_pos") -> DataFrame:
    """`df` with the 0-based `position` in `order` (names or sort columns) and, for every `sums` (out -> column), the sum up to and with the row.

    Sums are added as decimals of six digits behind the point, so they don't depend on the
    parts; a null counts as 0. Rows with equal order keys have some order among them. Starts a job.
    """
    sums = sums or {}
    mid, pid = "_mid", F.shiftright("_mid", 33)
    s = materialize(df.orderBy(*order).withColumn(mid, F.monotonically_increasing_id()), "running").withColumn("_pid", pid)
    each = {out: F.coalesce(F.col(c).cast(_MONEY), F.lit(0).cast(_MONEY)) for out, c in sums.items()}
    parts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), *(F.sum(x).alias(f"_{out}") for out, x in each.items())).orderBy("_pid").collect()  # a row for each part
    starts = [list(accumulate((p[c] for p in parts), initial=0)) for c in ["_n", *(f"_{out}" for out in sums)]]
    before = F.create_map(*(F.lit(v) for i, p in enumerate(parts) for v in (p["_pid"], i))) if parts else F.lit(None)
    at = F.element_at(before, F.col("_pid")) + 1 if parts else F.lit(1)
    start = lambda values, kind: F.element_at(F.array(*(F.lit(v).cast(kind) for v in values[: max(len(parts), 1)])), at)
    w = Window.partitionBy("_pid").orderBy(mid).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = s.withColumn(position, start(starts[0], "long") + F.col(mid).bitwiseAND((1 << 33) - 1))
    for (name, x), values in zip(each.items(), starts[1:], strict=True):
        out = out.withColumn(name, (start(values, _MONEY) + F.sum(x).over(w)).cast("double"))
    return out.drop(mid, "_pid")


def average_rank(df: DataFrame, value: str, out: str, by: list[str] | None = None, desc: bool = True) -> DataFrame:
    """`df` with the rank of `value` within `by`, equal values sharing the mean of their ranks (W-14). Null groups and values are values, nulls ranked last if `desc`.

    The distinct values are counted and ranked, so a value that stands in most rows is one row.
    """
    by = by or []
    keys = [*by, value]
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_ties"))
    order = [*by, F.col(value).desc() if desc else F.col(value).asc()]
    upto = running(counted, order, {"_upto": "_ties"}, "_pos")
    if by:
        first = upto.groupBy(*(F.col(k).alias(f"_b{i}") for i, k in enumerate(by))).agg(F.min(F.col("_upto") - F.col("_ties")).alias("_before"))
        upto = upto.join(first, [F.col(k).eqNullSafe(F.col(f"_b{i}")) for i, k in enumerate(by)])
    else:
        upto = upto.withColumn("_before", F.lit(0.0))
    ranked = upto.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), (F.col("_upto") - F.col("_before") - (F.col("_ties") - 1) / 2.0).alias(out))
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return df.join(ranked, same).drop(*(f"_k{i}" for i in range(len(keys))))
