"""Model jobs (M-01..M-06, S-09): Spark ML boosted trees and a grouped per-series ARIMA.

Training data stays distributed: string features are indexed, numeric features
imputed (NULL -> sentinel, plus the tree sees the sentinel as its own region),
assembled, and fitted with `GBTRegressor`. Per-series models run one Arrow group
per series (bounded by the series length).
"""

from __future__ import annotations

import math
import random
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import QuantileDiscretizer, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from shelfcast.session import discard, materialize, ship_package

NULL_SENTINEL = -1.0

# The first model's settings, and the tuned ones of the two boosters, under the
# names that Spark's trees have (they have no L1 / L2 terms; 248 leaves are a depth of 8).
BASELINE = {"stepSize": 0.05, "maxDepth": 8, "minInstancesPerNode": 100, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"}
XGB_TUNED = {"stepSize": 0.01713, "maxDepth": 10, "minInstancesPerNode": 39, "subsamplingRate": 0.9080,
             "featureSubsetStrategy": "0.6214"}
LGB_TUNED = {"stepSize": 0.04412, "maxDepth": 8, "minInstancesPerNode": 70, "subsamplingRate": 0.9338,
             "featureSubsetStrategy": "0.6784"}
# Search ranges (kind, low, high), number of trials, boosting rounds.
SEARCH_SPACE = {"stepSize": ("log", 0.01, 0.1), "maxDepth": ("int", 4, 10), "minInstancesPerNode": ("int", 20, 300),
                "subsamplingRate": ("float", 0.6, 1.0), "featureSubsetStrategy": ("share", 0.6, 1.0)}
TRIALS = 45
ROUNDS = 1000
# Boosting ends as soon as the error on the validation part rises. Spark's own default also ends
# it when the error falls by less than a hundredth, which at small steps is after the first tree.
STOP = 0.0


def gbt_pipeline(df: DataFrame, features: list[str], label: str = "sales_log", params: dict | None = None,
                 rounds: int = ROUNDS, seed: int = 42, validation_col: str | None = None,
                 codes_from: DataFrame | None = None) -> Pipeline:
    """Codes for the text features (fitted on `codes_from`, all parts), one vector, boosted trees."""
    strings = [c for c, t in df.select(*features).dtypes if t == "string"]
    numeric = [c for c in features if c not in strings]
    stages = []
    if strings:
        codes = StringIndexer(inputCols=strings, outputCols=[f"{c}__idx" for c in strings], handleInvalid="keep",
                              stringOrderType="alphabetAsc")
        stages.append(codes if codes_from is None else codes.fit(codes_from.select(*strings)))
        # codes are ordinal numbers for the trees (as in the label-encoded reference), not categories
        num_codes = ", ".join(f"`{c}__idx` + 0.0 AS `{c}__code`" for c in strings)
        stages.append(SQLTransformer(statement=f"SELECT *, {num_codes} FROM __THIS__"))
    stages.append(VectorAssembler(inputCols=numeric + [f"{c}__code" for c in strings], outputCol="features",
                                  handleInvalid="keep"))
    p = {"maxIter": rounds, "seed": seed, "maxBins": 64, "validationTol": STOP, **BASELINE, **(params or {})}
    gbt = GBTRegressor(featuresCol="features", labelCol=label, predictionCol="pred_log", **p)
    if validation_col:
        gbt.setValidationIndicatorCol(validation_col)
    stages.append(gbt)
    return Pipeline(stages=stages)


def impute(df: DataFrame, features: list[str]) -> DataFrame:
    num = [c for c, t in df.select(*features).dtypes if t != "string"]
    return df.select(*[F.coalesce(F.col(c).cast("double"), F.lit(NULL_SENTINEL)).alias(c) if c in num else F.col(c)
                       for c in df.columns])


def fit_gbt(train: DataFrame, features: list[str], label: str = "sales_log", val: DataFrame | None = None, **kw) -> PipelineModel:
    """Boosted trees on `train`; with `val`, boosting ends when its error no longer falls (M-01)."""
    if val is None:
        return gbt_pipeline(train, features, label, **kw).fit(impute(train, features))
    both = train.withColumn("_val", F.lit(False)).unionByName(val.withColumn("_val", F.lit(True)))
    return gbt_pipeline(both, features, label, validation_col="_val", **kw).fit(impute(both, features))


def sample_params(space: dict, rng: random.Random) -> dict:
    """One draw of every parameter from its range."""
    out = {}
    for name, (kind, low, high) in space.items():
        if kind == "int":
            out[name] = rng.randint(low, high)
        else:
            x = math.exp(rng.uniform(math.log(low), math.log(high))) if kind == "log" else rng.uniform(low, high)
            out[name] = f"{x:.4f}" if kind == "share" else round(x, 5)
    return out


def search_matrix(train: DataFrame, val: DataFrame, features: list[str], label: str = "sales_log", bins: int = 64, codes_from: DataFrame | None = None) -> DataFrame:
    """The rows of both parts as (features, label, _val), stored: what every trial of a search reads.

    Text features are codes, all others the numbers of up to `bins` bins of equal frequency of
    the train part (values outside its range belong to the outer bins, null counts as -1, NaN has a
    bin of its own).
    """
    strings = [c for c, t in train.select(*features).dtypes if t == "string"]
    numeric = [c for c in features if c not in strings]
    both = impute(train.withColumn("_val", F.lit(False)).unionByName(val.withColumn("_val", F.lit(True))), features)
    plain = []
    if strings:
        codes = StringIndexer(inputCols=strings, outputCols=[f"{c}__idx" for c in strings], handleInvalid="keep", stringOrderType="alphabetAsc")
        both = codes.fit((train if codes_from is None else codes_from).select(*strings)).transform(both)
        plain = [(F.col(f"{c}__idx") + F.lit(0.0)).alias(f"{c}__code") for c in strings]
    if numeric:
        cut = QuantileDiscretizer(inputCols=numeric, outputCols=[f"{c}__bin" for c in numeric], numBuckets=bins, relativeError=0.25 / bins, handleInvalid="keep")
        both = cut.fit(both.where("not _val")).transform(both)
        # bins are ordered numbers for the trees, not categories
        plain += [(F.col(f"{c}__bin") + F.lit(0.0)).alias(f"{c}__code") for c in numeric]
    assembled = VectorAssembler(inputCols=[f"{c}__code" for c in strings + numeric], outputCol="features")
    return materialize(assembled.transform(both.select(*plain, F.col(label).alias("label"), "_val")).select("features", "label", "_val"), "search-matrix")


def rungs(trials: int, rounds: int, eta: int = 3) -> list[tuple[int, int]]:
    """(trials, rounds) of each rung: as many trials as the last have fewer rounds, so that every rung costs about the same."""
    levels = 0
    while trials // eta ** (levels + 1) >= 1 and rounds // eta ** (levels + 1) >= 1:
        levels += 1
    return [(max(1, trials // eta**k), max(1, rounds // eta ** (levels - k))) for k in range(levels + 1)]


def search(train: DataFrame, val: DataFrame, features: list[str], trials: int = TRIALS, rounds: int = ROUNDS, seed: int = 42, space: dict | None = None,
           codes_from: DataFrame | None = None, eta: int = 3, parallel: int = 4) -> tuple[list[tuple[dict, int, float]], dict]:
    """Random search by successive halving (M-02): all trials get few rounds, the best `eta`-th of them `eta` times as many, and so on to `rounds`.

    Every fit ends early when its error on `val` no longer falls. Trials of a rung are
    concurrent jobs, `parallel` at a time, over one stored matrix (`search_matrix`). Returns one
    (parameters, rounds, RMSLE on val) for every fit, in the order of rungs and then of the
    draws, and the best parameters of the last rung. Parameters of equal error: the ones drawn first.
    """
    rng, found = random.Random(seed), []
    alive = [sample_params(space or SEARCH_SPACE, rng) for _ in range(trials)]
    matrix = search_matrix(train, val, features, codes_from=codes_from)
    held = matrix.where("_val")
    # predictions below 0 on the log scale are forecasts of 0
    error = F.sqrt(F.avg(F.pow(F.greatest("pred", F.lit(0.0)) - F.greatest("label", F.lit(0.0)), F.lit(2.0)))).alias("e")

    def trial(params: dict, most: int) -> float:
        p = {"maxIter": most, "seed": seed, "maxBins": 64, "validationTol": STOP, **BASELINE, **params}
        return GBTRegressor(featuresCol="features", labelCol="label", predictionCol="pred", validationIndicatorCol="_val", **p).fit(matrix).transform(held).agg(error).first()["e"]

    for count, most in rungs(trials, rounds, eta):
        alive = alive[:count]
        with ThreadPoolExecutor(parallel) as pool:
            jobs = [pool.submit(inheritable_thread_target(matrix.sparkSession)(trial), params, most) for params in alive]
            errors = [j.result() for j in jobs]
        found += [(params, most, e) for params, e in zip(alive, errors, strict=True)]
        alive = [alive[i] for i in sorted(range(len(alive)), key=lambda i: (math.inf if errors[i] is None else errors[i], i))]
    discard(matrix)
    return found, alive[0]


def blended(models: list[tuple[PipelineModel, float]], df: DataFrame, features: list[str]) -> DataFrame:
    """`df` with `predicted`: the weighted sum of the models' log predictions, back in units, not below 0 (P-22)."""
    for i, (model, _) in enumerate(models):
        df = predict(model, df, features).select(*df.columns, F.col("pred_log").alias(f"_log{i}"))
    total = sum((F.col(f"_log{i}") * w for i, (_, w) in enumerate(models)), F.lit(0.0))
    return df.withColumn("predicted", F.greatest(F.expm1(total), F.lit(0.0))).drop(*(f"_log{i}" for i in range(len(models))))


def check_submission(submission: DataFrame, future: DataFrame, value: str = "sales") -> None:
    """A forecast for every future row, none null, none negative (C-19); raises otherwise."""
    s = submission.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.count_if(F.col(value).isNull()).alias("nulls"), F.count_if(F.col(value) < 0).alias("below")).first()
    rows = future.count()
    if (s["n"], s["ids"], s["nulls"], s["below"]) != (rows, rows, 0, 0):
        raise ValueError(f"submission of {s['n']} rows ({s['ids']} ids) for {rows}: {s['nulls']} null, {s['below']} negative")


def predict(model: PipelineModel, df: DataFrame, features: list[str]) -> DataFrame:
    """Adds `pred_log` and `predicted` = max(expm1(pred_log), 0)."""
    out = model.transform(impute(df, features))
    return out.withColumn("predicted", F.greatest(F.expm1("pred_log"), F.lit(0.0))).drop("features")


def importances(model: PipelineModel, features: list[str], spark, top: int = 20) -> DataFrame:
    """Feature importances of the fitted booster, top `top` (a vector of #features values)."""
    gbt = model.stages[-1]
    asm = [s for s in model.stages if isinstance(s, VectorAssembler)][0]
    names = asm.getInputCols()
    vals = gbt.featureImportances.toArray().tolist()
    df = spark.createDataFrame([(n.replace("__code", ""), float(v)) for n, v in zip(names, vals)], "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


# ---------------------------------------------------------------- per-series ARIMA (Hannan-Rissanen)

def _hr_fit(w: np.ndarray, ar_lags: list[int], ma_lags: list[int], long_ar: int = 20):
    """Two-stage least squares ARMA fit: long AR for innovations, then regression on lags."""
    n = len(w)
    m = min(long_ar, max(1, n // 4))
    if n <= m + max(ar_lags + ma_lags + [1]) + 5:
        raise ValueError("series too short")
    X = np.column_stack([w[m - i - 1:n - i - 1] for i in range(m)])
    y = w[m:]
    b, *_ = np.linalg.lstsq(np.column_stack([X, np.ones(len(y))]), y, rcond=None)
    e = np.zeros(n)
    e[m:] = y - np.column_stack([X, np.ones(len(y))]) @ b
    start = m + max(ar_lags + ma_lags)
    cols = [w[start - k:n - k] for k in ar_lags] + [e[start - k:n - k] for k in ma_lags]
    Z = np.column_stack(cols + [np.ones(n - start)])
    coef, *_ = np.linalg.lstsq(Z, w[start:], rcond=None)
    if not np.all(np.isfinite(coef)):
        raise ValueError("non-finite fit")
    resid = np.zeros(n)
    resid[start:] = w[start:] - Z @ coef
    return coef, resid


def _forecast(w, resid, coef, ar_lags, ma_lags, h):
    w = list(w)
    e = list(resid)
    out = []
    for _ in range(h):
        val = coef[-1]
        for i, k in enumerate(ar_lags):
            val += coef[i] * w[-k]
        for j, k in enumerate(ma_lags):
            val += coef[len(ar_lags) + j] * e[-k]
        w.append(val)
        e.append(0.0)
        out.append(val)
    return np.array(out)


def _undiff(y: np.ndarray, wf: np.ndarray, s: int | None) -> np.ndarray:
    """Invert (1-B)(1-B^s) (or 1-B) differencing for forecasts wf appended to history y."""
    hist = list(y)
    out = []
    for v in wf:
        if s:
            nxt = v + hist[-1] + hist[-s] - hist[-s - 1]
        else:
            nxt = v + hist[-1]
        hist.append(nxt)
        out.append(nxt)
    return np.array(out)


def arima_forecast(y_log: np.ndarray, h: int, season: int = 7) -> tuple[np.ndarray | None, str]:
    """SARIMA(1,1,1)x(1,1,1,s) by Hannan-Rissanen, fallback ARIMA(1,1,1), else FAILED."""
    try:
        w = np.diff(y_log)
        w = w[season:] - w[:-season]
        ar, ma = [1, season, season + 1], [1, season, season + 1]
        coef, resid = _hr_fit(w, ar, ma)
        wf = _forecast(w, resid, coef, ar, ma, h)
        return _undiff(y_log, wf, season), f"SARIMA(1,1,1)x(1,1,1,{season})"
    except (ValueError, np.linalg.LinAlgError):  # too short, or no finite fit
        pass
    try:
        w = np.diff(y_log)
        coef, resid = _hr_fit(w, [1], [1])
        wf = _forecast(w, resid, coef, [1], [1], h)
        return _undiff(y_log, wf, None), "ARIMA(1,1,1)"
    except (ValueError, np.linalg.LinAlgError):
        return None, "FAILED"


def arima_per_series(history: DataFrame, keys: list[str], h: int, value: str = "sales", date: str = "date") -> DataFrame:
    """One grouped job over all series: log1p, fit, h-step forecast, expm1, floor 0."""
    key_types = history.select(*keys).dtypes
    schema = ", ".join([f"{k} {t}" for k, t in key_types] + ["h int", "pred double", "model_order string"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        y = np.log1p(np.clip(pdf[value].to_numpy(dtype=float), 0, None))
        f, order = arima_forecast(y, h)
        preds = np.maximum(np.expm1(f), 0) if f is not None else np.full(h, np.nan)
        out = pd.DataFrame({"h": np.arange(1, h + 1), "pred": preds, "model_order": order})
        for k in reversed(keys):
            out.insert(0, k, pdf[k].iloc[0])
        return out

    ship_package(history.sparkSession)
    return history.select(*keys, date, value).groupBy(*keys).applyInPandas(run, schema)
