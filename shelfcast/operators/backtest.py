"""Rolling-origin evaluation (M-06, V-02, V-04): several models forecast from several origins into one table of predictions.

A row of predictions has the keys of its series, `origin` (the first day that the model hasn't
seen), date, model, detail (the order that was fitted; null where there is none), actual and
predicted (null: the model has no forecast for the day). All reports read such a table, so a
model is evaluated the same way wherever its predictions come from.
"""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.functions.numeric import decimal_mean
from shelfcast.operators import models as mdl
from shelfcast.operators.encoders import target_encode_apply, target_encode_fit
from shelfcast.operators.evaluate import metric_columns
from shelfcast.session import ship_package

COLUMNS = ["origin", "date", "model", "detail", "actual", "predicted"]


def origins(last: dt.date, count: int, step: int) -> list[dt.date]:
    """`count` first days of forecasts, `step` days apart, the latest is `last`."""
    return [last - dt.timedelta(days=step * k) for k in reversed(range(count))]


def around(panel: DataFrame, keys: list[str], starts: list[dt.date], back: int, horizon: int, value: str = "sales", date: str = "date") -> DataFrame:
    """The days from `back` before to `horizon` after each origin, as (keys, origin, date, h, actual); h is 0 on the origin.

    A day near several origins comes once for each. All other days are left out at the scan.
    """
    d = F.col(date)
    near = F.filter(F.array(*[F.lit(o) for o in starts]), lambda o: (d >= F.date_sub(o, back)) & (d < F.date_add(o, horizon)))
    days = panel.where(d.between(F.lit(min(starts) - dt.timedelta(days=back)), F.lit(max(starts) + dt.timedelta(days=horizon - 1))))
    rows = days.select(*keys, date, F.col(value).cast("double").alias("actual"), near.alias("near")).withColumnRenamed(date, "date")
    return rows.select(*keys, "date", "actual", F.explode("near").alias("origin")).withColumn("h", F.datediff("date", "origin"))


def simple_forecasts(panel: DataFrame, keys: list[str], starts: list[dt.date], horizon: int, season: int = 7, back: int = 28, value: str = "sales", decimals: int | None = None) -> DataFrame:
    """Predictions of two models without a fit, in built-in functions and one shuffle.

    `seasonal_naive` repeats the last `season` days before the origin, `mean` is the average of
    the last `back`. A day that is missing there gives a null forecast; a series without any
    row in the horizon gives no row. `decimals`: of money values; their mean is then exact, to 6 digits.
    """
    window = Window.partitionBy(*keys, "origin")
    place = Window.partitionBy(*keys, "origin", "place")
    rows = around(panel, keys, starts, max(back, season), horizon, value).withColumn("place", F.pmod("h", F.lit(season)))
    known = F.when(F.col("h").between(-back, -1), F.col("actual"))
    mean = F.avg(known).over(window) if decimals is None else F.round(decimal_mean(known, window, decimals), 6).cast("double")
    rows = rows.withColumn("mean", mean)
    rows = rows.withColumn("naive", F.max(F.when(F.col("h").between(-season, -1), F.col("actual"))).over(place)).where("h >= 0")
    models = F.explode(F.array(F.struct(F.lit("seasonal_naive").alias("model"), F.col("naive").alias("predicted")), F.struct(F.lit("mean").alias("model"), F.col("mean").alias("predicted"))))
    return rows.select(*keys, "origin", "date", "actual", models.alias("m")).select(*keys, "origin", "date", "m.model", F.lit(None).cast("string").alias("detail"), "actual", "m.predicted")


def arima_forecasts(panel: DataFrame, keys: list[str], starts: list[dt.date], horizon: int, value: str = "sales", date: str = "date") -> DataFrame:
    """Predictions of the seasonal ARIMA: one group per series, which is fitted anew at each origin.

    Days without a row before an origin play no part in its fit. A series that is too short at
    an origin has null forecasts there, with the detail FAILED. Days of the horizon without a row
    have no prediction.
    """
    schema = ", ".join([f"`{k}` {t}" for k, t in panel.select(*keys).dtypes] + ["origin date, date date, model string, detail string, actual double, predicted double"])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(date)
        days = pd.to_datetime(pdf[date]).to_numpy().astype("datetime64[D]")
        values = pdf[value].to_numpy(dtype=float)
        out = []
        for origin in starts:
            first = np.datetime64(origin, "D")
            known, h = (days < first) & ~np.isnan(values), (days - first).astype(int)
            forecast, order = mdl.arima_forecast(np.log1p(np.clip(values[known], 0, None)), horizon)
            asked = (h >= 0) & (h < horizon)
            predicted = np.maximum(np.expm1(forecast[h[asked]]), 0.0) if forecast is not None else np.full(asked.sum(), np.nan)
            out.append(pd.DataFrame({"origin": origin, "date": days[asked].astype(object), "model": "arima", "detail": order, "actual": values[asked], "predicted": predicted}))
        rows = pd.concat(out, ignore_index=True)
        for k in reversed(keys):
            rows.insert(0, k, pdf[k].iloc[0])
        return rows

    ship_package(panel.sparkSession)
    rows = panel.select(*keys, date, F.col(value).cast("double").alias(value)).where(F.col(date) < F.lit(max(starts) + dt.timedelta(days=horizon)))
    return rows.groupBy(*keys).applyInPandas(run, schema)


def booster_forecasts(table: DataFrame, keys: list[str], starts: list[dt.date], horizon: int, features: list[str], settings: list[tuple[dict, float]], rounds: int = mdl.ROUNDS,
                      value: str = "sales", lags: dict[str, int] | None = None, encoded: tuple[str, str] | None = None, name: str = "boosters") -> DataFrame:
    """Predictions of boosted trees, blended by weight, that are fitted on the rows of `table` before each origin.

    `lags` gives, for each feature that looks back fewer days than the horizon is long, that
    number of days: from there on it isn't known and is null, as in a real forecast. `encoded`
    names a key and its target encoding, which is fitted anew on the rows before each origin.
    `settings`: parameters and weight of each booster. One fit per origin and booster, one after another.
    """
    out, types = None, dict(table.dtypes)
    for origin in starts:
        history = table.where(F.col("date") < F.lit(origin))
        asked = table.where(F.col("date").between(F.lit(origin), F.lit(origin + dt.timedelta(days=horizon - 1))))
        asked = asked.withColumns({c: F.when(F.datediff("date", F.lit(origin)) < n, F.col(c)) for c, n in (lags or {}).items()})
        if encoded:
            codes = target_encode_fit(history, encoded[0], value)
            history, asked = (target_encode_apply(x.drop(encoded[1]), codes, *encoded) for x in (history, asked))
        fitted = [(mdl.fit_gbt(history, features, params=p, rounds=rounds, codes_from=table), w) for p, w in settings]
        rows = mdl.blended(fitted, asked, features).select(*[F.col(k).cast(types[k]).alias(k) for k in keys], F.lit(origin).alias("origin"), "date", F.lit(name).alias("model"), F.lit(None).cast("string").alias("detail"),
                                                           F.col(value).cast("double").alias("actual"), "predicted")
        out = rows if out is None else out.unionByName(rows)
    return out


def history_days(panel: DataFrame, keys: list[str], starts: list[dt.date], date: str = "date") -> DataFrame:
    """(keys, origin, train_days): rows of each series before each origin, in one aggregate that is combined before its shuffle."""
    counts = panel.groupBy(*keys).agg(F.array(*[F.struct(F.lit(o).alias("origin"), F.count_if(F.col(date) < F.lit(o)).alias("train_days")) for o in starts]).alias("c"))
    return counts.select(*keys, F.explode("c").alias("c")).select(*keys, "c.origin", "c.train_days")


def scores(predictions: DataFrame, by: list[str]) -> DataFrame:
    """Errors per group and model, with the number of rows and of those without a forecast."""
    missing = F.count_if(F.col("predicted").isNull()).alias("failed")
    return predictions.groupBy(*by, "model").agg(*metric_columns("actual", "predicted"), F.count(F.lit(1)).alias("n_rows"), missing)


def comparison(predictions: DataFrame, train_days: DataFrame, keys: list[str], models: list[str], digits: int = 6) -> DataFrame:
    """One row per series and origin: days of history and of validation, each model's RMSLE, order and missing forecasts, the best model.

    A model without any forecast has a null RMSLE and can't be the best; of equal models the
    first of `models` is. One aggregate over the predictions, whatever number of models.
    """
    squared = F.pow(F.log1p(F.greatest("predicted", F.lit(0.0))) - F.log1p(F.greatest("actual", F.lit(0.0))), F.lit(2.0))
    both = F.col("predicted").isNotNull() & F.col("actual").isNotNull()
    of = {m: F.col("model") == m for m in models}
    errors = [F.round(F.sqrt(F.avg(F.when(of[m] & both, squared))), digits).alias(f"rmsle_{m}") for m in models]
    failed = [F.count_if(of[m] & F.col("predicted").isNull()).alias(f"failed_{m}") for m in models]
    rows = predictions.groupBy(*keys, "origin").agg(F.count_distinct("date").alias("val_days"), F.max("detail").alias("order"), *errors, *failed)
    least = F.least(*[F.col(f"rmsle_{m}") for m in models]) if len(models) > 1 else F.col(f"rmsle_{models[0]}")
    best = F.coalesce(*[F.when(F.col(f"rmsle_{m}") == least, F.lit(m)) for m in models])
    return rows.join(train_days, [*keys, "origin"]).select(*keys, "origin", "train_days", "val_days", "order", *[f"rmsle_{m}" for m in models], *[f"failed_{m}" for m in models], best.alias("best"))


def wins(compared: DataFrame, models: list[str]) -> DataFrame:
    """Per model: series and origins at which it is the best, its mean RMSLE over them all, and how far its RMSLE varies between origins."""
    one = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.col(f"rmsle_{m}").alias("rmsle"), F.col(f"failed_{m}").alias("failed")) for m in models])).alias("m")
    rows = compared.select("origin", "best", one)
    per = rows.groupBy("m.model", "origin").agg(F.count_if(F.col("best") == F.col("m.model")).alias("w"), F.sum("m.rmsle").alias("s"), F.count("m.rmsle").alias("n"), F.sum("m.failed").alias("f"))
    return per.groupBy("model").agg(F.sum("w").alias("wins"), F.round(F.try_divide(F.sum("s"), F.sum("n")), 6).alias("mean_rmsle"), F.round(F.max(F.try_divide("s", "n")) - F.min(F.try_divide("s", "n")), 6).alias("spread"), F.sum("f").alias("failed"))


def gaps(predictions: DataFrame, base: str, others: list[str]) -> DataFrame:
    """Per origin, the errors of `base` and of each other model with their differences (V-03)."""
    s = scores(predictions, ["origin"])
    a = s.where(F.col("model") == base).alias("a")
    b = s.where(F.col("model").isin(others)).alias("b")
    pairs = [F.col(f"a.{m}").alias(f"{m}_base") for m in ("rmsle", "mae")] + [F.col(f"b.{m}") for m in ("rmsle", "mae")]
    diff = [F.round(F.col(f"b.{m}") - F.col(f"a.{m}"), 6).alias(f"{m}_gap") for m in ("rmsle", "mae")]
    return a.join(b, "origin").select("origin", F.col("b.model"), *pairs, *diff)
