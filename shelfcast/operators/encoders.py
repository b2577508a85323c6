"""Encoders (E-01..E-07) and the global row position they depend on (W-18).

Mapping tables (label codes, frequencies, target statistics) have one row per
category value; they are built by aggregation and joined back, the planner and AQE
decide how from their size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.operators.ranks import running


# ---------------------------------------------------------------- row position / folds

def row_position(df: DataFrame, order: list[str], out_col: str = "row_pos") -> DataFrame:
    """0-based position of every row in a total order, computed without a single-partition window.

    The frame is range-partitioned and sorted on `order` (a unique key, so a hot leading
    value is still split across tasks) and written once to the shared folder, see `running`.
    """
    return running(df, order, position=out_col)


def contiguous_fold(pos: Column, n: Column, k: int) -> Column:
    """Fold of a 0-based position for k contiguous folds; the first n mod k folds hold one extra row."""
    q = F.floor(n / k)
    big = n % k
    edge = big * (q + 1)
    return F.when(pos < edge, F.floor(pos / (q + 1))).otherwise(big + F.floor(F.try_divide(pos - edge, q))).cast("int")


def kfold_contiguous(df: DataFrame, order: list[str], k: int = 5, fold_col: str = "fold") -> DataFrame:
    """Unshuffled k-fold assignment along `order` (scikit-learn KFold(shuffle=False) layout)."""
    p = row_position(df, order)
    n = p.agg(F.count(F.lit(1))).scalar()
    return p.withColumn(fold_col, contiguous_fold(F.col("row_pos"), n, k))


# ---------------------------------------------------------------- label / frequency

def label_mapping(values: DataFrame, col: str, code_col: str | None = None) -> DataFrame:
    """Sorted distinct values, of any number -> 0..k-1."""
    code_col = code_col or f"{col}_code"
    d = values.select(col).where(F.col(col).isNotNull()).distinct()
    return running(d, [col], position=code_col).select(col, F.col(code_col).cast("int"))


def label_encode(df: DataFrame, col: str, fit_on: list[DataFrame] | None = None, code_col: str | None = None,
                 unseen: int | None = -1) -> DataFrame:
    """Codes fitted on the union of `fit_on` (default: df itself); values not in the fit get `unseen`."""
    code_col = code_col or f"{col}_code"
    src = None
    for f in fit_on or [df]:
        part = f.select(col)
        src = part if src is None else src.unionByName(part)
    m = label_mapping(src, col, code_col)
    out = df.join(m, col, "left")
    if unseen is not None:
        out = out.withColumn(code_col, F.coalesce(F.col(code_col), F.lit(unseen)))
    return out


def frequency_mapping(base: DataFrame, col: str, out_col: str | None = None) -> DataFrame:
    """value -> share of `base` rows holding it."""
    out_col = out_col or f"{col}_freq"
    c = base.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_c"))
    total = base.where(F.col(col).isNotNull()).agg(F.count(F.lit(1))).scalar()
    return c.select(col, (F.col("_c") / total).alias(out_col))


def frequency_encode(df: DataFrame, col: str, base: DataFrame | None = None, out_col: str | None = None,
                     unseen: float = 0.0) -> DataFrame:
    """Share of `base` rows (default: df's own rows; pass the store table for a per-store base)."""
    out_col = out_col or f"{col}_freq"
    m = frequency_mapping(df if base is None else base, col, out_col)
    out = df.join(m, col, "left")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.lit(unseen)))


# ---------------------------------------------------------------- target encoding

M_ESTIMATE, SIGMOID = "m_estimate", "sigmoid"


def blend(n: Column, mean: Column, prior: Column, how: str = M_ESTIMATE, m: float = 10.0,
          k: float = 20.0, s: float = 10.0) -> Column:
    """Smoothed category mean. m-estimate: (n*mean + m*prior)/(n+m); sigmoid: w*mean + (1-w)*prior."""
    if how == M_ESTIMATE:
        return (n * mean + F.lit(m) * prior) / (n + F.lit(m))
    w = F.lit(1.0) / (F.lit(1.0) + F.exp(-(n - F.lit(k)) / F.lit(s)))
    return w * mean + (F.lit(1.0) - w) * prior


def target_encode_fit(train: DataFrame, key: str, target: str, how: str = M_ESTIMATE, **kw) -> DataFrame:
    """key -> smoothed mean of target on `train`, plus the prior (global mean) on each row."""
    prior = train.agg(F.avg(target)).scalar()
    st = train.groupBy(key).agg(F.count(target).alias("_n"), F.avg(target).alias("_m"))
    return st.select(key, blend(F.col("_n"), F.col("_m"), prior, how, **kw).alias("_te"), prior.alias("_prior"))


def target_encode_apply(df: DataFrame, mapping: DataFrame, key: str, out_col: str) -> DataFrame:
    """Join the fitted mapping; unseen keys get the prior."""
    prior = mapping.agg(F.first("_prior")).scalar()
    j = df.join(mapping.select(key, "_te"), key, "left")
    return j.withColumn(out_col, F.coalesce(F.col("_te"), prior)).drop("_te")


def target_encode_oof(df: DataFrame, key: str, target: str, fold_col: str = "fold", out_col: str | None = None,
                      how: str = M_ESTIMATE, stats_on: DataFrame | None = None, **kw) -> DataFrame:
    """Out-of-fold target encoding in one aggregate: statistics of the other folds = totals - own fold.

    `stats_on`: a frame with the same rows, fold, key and target to take the statistics from,
    where `df` carries joins that they don't need.

    The prior of fold f is the target mean of all rows outside f. No per-fold refit loop.
    The (fold, key) table has k x #keys rows; the per-fold table has k rows.
    """
    out_col = out_col or f"{key}_te"
    src = df if stats_on is None else stats_on
    fk = src.groupBy(fold_col, key).agg(F.sum(target).alias("_fs"), F.count(target).alias("_fn"))
    per_key = Window.partitionBy(key)
    fk = fk.select("*", F.sum("_fs").over(per_key).alias("_ts"), F.sum("_fn").over(per_key).alias("_tn"))
    # per-fold totals (k rows) from the (fold, key) sums; global totals as the sums of those k rows
    ff = fk.groupBy(fold_col).agg(F.sum("_fs").alias("_ps"), F.sum("_fn").alias("_pn"))
    whole = ff.agg(F.sum("_ps").alias("s"), F.sum("_pn").alias("n"))
    ff = ff.select("*", whole.select("s").scalar().alias("_gs"), whole.select("n").scalar().alias("_gn"))
    ff = ff.select(fold_col, "_ps", "_pn", F.try_divide(F.col("_gs") - F.col("_ps"), F.col("_gn") - F.col("_pn")).alias("_fp"))
    stats = fk.join(ff, fold_col)
    n_oof = F.col("_tn") - F.col("_fn")
    mean_oof = F.try_divide(F.col("_ts") - F.col("_fs"), n_oof)
    prior = F.col("_fp")
    enc = F.when(n_oof > 0, blend(n_oof, mean_oof, prior, how, **kw)).otherwise(prior)
    m = stats.select(fold_col, key, enc.alias(out_col))
    # keys absent from the other folds and keys unseen in df both fall back to that fold's prior
    out = df.join(m, [fold_col, key], "left").join(ff.select(fold_col, "_fp"), fold_col, "left")
    return out.withColumn(out_col, F.coalesce(F.col(out_col), F.col("_fp"))).drop("_fp")
