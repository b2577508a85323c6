"""Exact quantiles and moments of ungrouped columns by distributed selection: no sort, no file.

One pass counts the values of all columns in buckets of a logarithmic scale, each with its
count, bounds and moments. The buckets that hold a wanted rank are then narrowed in further
passes: a large one is cut into finer buckets between its own bounds, a small one into its
distinct values. Every pass is one aggregate with map-side combination; what comes to the
driver are bucket counts, whose number is bounded whatever the number of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of the first pass per factor e (at most some 93,000 in all), of a later pass per bucket, rows that count as few.
PER_E, FINE, FEW = 32, 1 << 14, 50_000


@dataclass
class Summary:
    """Moments and quantiles of one column's values that are neither null nor NaN (None where there are too few)."""

    count: int
    mean: float | None
    std: float | None
    min: float | None
    max: float | None
    quantiles: list[float | None]


@dataclass
class _Part:
    """A range of one column's values: rows below it, rows in it, its bounds."""

    column: int
    below: int
    size: int
    low: float
    high: float


def _scale(x: Column) -> Column:
    """A bucket number that grows with x."""
    step = F.floor(F.least(F.ln(F.abs(x)), F.lit(1000.0)) * PER_E) + 24_000
    return F.when(x == 0, F.lit(0).cast("double")).otherwise((F.signum(x) * step).cast("double"))


def _values(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (column, x) of the values of all columns."""
    one = [F.struct(F.lit(i).alias("column"), (F.col(c).cast("double") + F.lit(0.0)).alias("x")) for i, c in enumerate(cols)]
    return df.select(F.inline(F.array(*one))).where(F.col("x").isNotNull() & ~F.isnan("x"))


def _total(values) -> float:
    values = list(values)
    try:
        return math.fsum(values)
    except (OverflowError, ValueError):  # beyond the largest number, or infinite values of both signs
        return sum(values)


def _ranks(n: int, p: float) -> tuple[int, int]:
    h = (n - 1) * p
    return math.floor(h), math.ceil(h)


def _cut(column: int, rows: list, below: int) -> list[_Part]:
    parts = []
    for r in sorted(rows, key=lambda r: r["bucket"]):
        parts.append(_Part(column, below, r["n"], r["low"], r["high"]))
        below += r["n"]
    return parts


def summarize(df: DataFrame, probs: dict[str, list[float]], few: int = FEW, fine: int = FINE) -> dict[str, Summary]:
    """`Summary` of every column of `probs`, with its quantiles by linear interpolation between ranks.

    Reads `df` once, and again until each wanted rank's range has one value: twice in all
    where a bucket of 3 % of the scale holds up to `few` rows, else three or four times.
    Infinite values are values; without any value a column has a count of 0 and no quantiles.
    """
    cols = list(probs)
    first = _values(df, cols).groupBy("column", _scale(F.col("x")).alias("bucket"))
    rows = first.agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high"), F.avg("x").alias("mean"), F.var_pop("x").alias("var")).collect()
    out, known, open_parts = {}, {}, {}
    for i, c in enumerate(cols):
        own = [r for r in rows if r["column"] == i]
        n = sum(r["n"] for r in own)
        mean = _total(r["n"] * r["mean"] for r in own) / n if n else None
        around = _total(r["n"] * (r["var"] + (r["mean"] - mean) * (r["mean"] - mean)) for r in own)
        out[c] = Summary(n, mean, math.sqrt(around / (n - 1)) if n > 1 else None, min((r["low"] for r in own), default=None), max((r["high"] for r in own), default=None), [])
        known[i] = {}
        open_parts[i] = (_cut(i, own, 0), {k for p in probs[c] for k in _ranks(n, p)} if n else set())
    while True:
        wanted = []
        for i, (parts, ranks) in open_parts.items():
            for part in parts:
                inside = {k for k in ranks if part.below <= k < part.below + part.size}
                if part.low == part.high:
                    known[i].update(dict.fromkeys(inside, part.low))
                elif inside:
                    wanted.append((part, inside))
        if not wanted:
            break
        open_parts = {i: ([], set()) for i in open_parts}
        x, which, bucket = F.col("x"), F.lit(None).cast("int"), F.lit(None).cast("double")
        for k, (part, inside) in enumerate(wanted):
            here = (F.col("column") == part.column) & x.between(F.lit(part.low), F.lit(part.high))
            place = x if part.size <= few else F.least(F.floor((x - part.low) / (part.high - part.low) * fine), F.lit(fine - 1)).cast("double")
            which, bucket = F.when(here, k).otherwise(which), F.when(here, place).otherwise(bucket)
            open_parts[part.column][1].update(inside)
        finer = _values(df, cols).select("x", which.alias("which"), bucket.alias("bucket")).where("which is not null").groupBy("which", "bucket")
        rows = finer.agg(F.count("x").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")).collect()
        for k, (part, _) in enumerate(wanted):
            open_parts[part.column][0].extend(_cut(part.column, [r for r in rows if r["which"] == k], part.below))
    for i, c in enumerate(cols):
        n = out[c].count
        for p in probs[c]:
            low, high = _ranks(n, p)
            a, b = known[i].get(low), known[i].get(high)
            out[c].quantiles.append(None if a is None or b is None else a if a == b else a + ((n - 1) * p - low) * (b - a))
    return out
