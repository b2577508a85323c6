"""Profiling and data-quality operators (C-01..C-22, R-09) and exact quantiles.

Column-wise reports are computed in ONE aggregate pass over the data (partial
aggregation on every task) and then turned long with `stack`; nothing is
collected. Exact quantiles of ungrouped columns come from `operators/quantiles.py`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import summarize


def _stack(row: DataFrame, names: list[str], fields: list[str], name_col: str = "column") -> DataFrame:
    """1-row wide frame with `<name>__<field>` columns -> one row per name."""
    n = len(names)
    args = ", ".join(f"'{c}', " + ", ".join(f"`{c}__{f}`" for f in fields) for c in names)
    return row.selectExpr(f"stack({n}, {args}) AS ({name_col}, {', '.join(fields)})")


def exact_quantiles(df: DataFrame, col: str, probs: list[float], prefix: str = "q") -> DataFrame:
    """One row: linear-interpolated exact quantiles (pandas / numpy default) of a column. Starts jobs."""
    found = summarize(df, {col: probs})[col].quantiles
    return df.sparkSession.range(1).select(*(F.lit(v).cast("double").alias(f"{prefix}{_pname(p)}") for p, v in zip(probs, found, strict=True)))


def _pname(p: float) -> str:
    return str(round(p * 100, 4)).rstrip("0").rstrip(".").replace(".", "_")


def describe(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    """count, mean, std (n-1), min, 25/50/75 %, max per column, one row per column (C-01). Starts jobs."""
    found = summarize(df, {c: [0.25, 0.5, 0.75] for c in cols})
    rows = []
    for c in cols:
        s = found[c]
        exact = lambda v: F.lit(v).cast("double")
        rounded = lambda v: F.round(F.lit(v).cast("double"), digits)
        values = {"mean": rounded(s.mean), "std": rounded(s.std), "min": exact(s.min), **{f"p{k}": rounded(q) for k, q in zip((25, 50, 75), s.quantiles, strict=True)}, "max": exact(s.max)}
        rows.append(F.struct(F.lit(c).alias("column"), F.lit(s.count).cast("long").alias("count"), *(v.alias(k) for k, v in values.items())))
    return df.sparkSession.range(1).select(F.inline(F.array(*rows)))


def missing_summary(df: DataFrame, cols: list[str] | None = None, threshold: float | None = None) -> DataFrame:
    """Null count and percent per column; only columns with nulls (C-02). With `threshold`,
    adds `high_null` = rate > threshold (C-03)."""
    cols = cols or df.columns
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__missing"))
    row = df.agg(*aggs)
    long = _stack(row.drop("_n"), cols, ["missing"]).select(
        "column", F.col("missing").cast("long").alias("missing"))
    n = row.select("_n").scalar()
    out = long.where("missing > 0").select("column", "missing", F.round(F.col("missing") * 100.0 / n, 6).alias("percent"))
    if threshold is not None:
        out = out.withColumn("high_null", F.col("percent") > threshold * 100)
    return out


def value_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """min, max and null count per column, one row per column (R-09)."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.count_if(F.col(c).isNull()).alias(f"{c}__nulls")]
    return _stack(df.agg(*aggs), cols, ["min", "max", "nulls"])


def duplicate_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of key values occurring more than once and the surplus rows (C-12)."""
    g = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1")
    return g.agg(F.count(F.lit(1)).alias("dup_keys"), F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("dup_rows"))


def null_counts(df: DataFrame, cols: list[str], where: Column | None = None) -> DataFrame:
    """count_if(col is null) per column (optionally inside a predicate), one row per column (C-13, C-16)."""
    d = df.where(where) if where is not None else df
    row = d.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols],
                F.count(F.lit(1)).alias("_n"))
    long = _stack(row.drop("_n"), cols, ["nulls"])
    return long.select("column", F.col("nulls").cast("long").alias("nulls"), row.select("_n").scalar().alias("n_rows"))


def coverage(df: DataFrame, cols: list[str]) -> DataFrame:
    """Null count and covered share per column (C-22)."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__nulls") for c in cols],
                 *[F.avg(F.col(c).isNotNull().cast("double")).alias(f"{c}__covered") for c in cols])
    long = _stack(row, cols, ["nulls", "covered"])
    return long.select("column", F.col("nulls").cast("long").alias("nulls"), F.round("covered", 9).alias("covered"))


def clean_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """Strip column names and require a set of columns (C-04)."""
    out = df.toDF(*[c.strip() for c in df.columns])
    missing = sorted(set(required) - set(out.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return out


def coerce(df: DataFrame, dates: list[str] = (), numbers: dict[str, str] | None = None,
           drop_invalid: bool = True) -> DataFrame:
    """Parse dates / numbers with try_* functions; rows that fail are dropped (C-05, C-06)."""
    out = df
    for c in dates:
        out = out.withColumn(c, F.try_to_date(F.col(c).cast("string")))
    for c, t in (numbers or {}).items():
        out = out.withColumn(c, F.expr(f"try_cast(`{c}` AS {t})"))
    subset = list(dates) + list(numbers or {})
    return out.dropna(subset=subset) if drop_invalid and subset else out
