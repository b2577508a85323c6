"""Model, forecast, horizon and sink queries (M-01..M-06, F-07, U-01, S-01, S-04, S-06..S-09, C-04, C-17)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from shelfcast.catalog.external import OIL_DAILY_SQL
from shelfcast.catalog.holidays import FLAGS_SQL, VH
from shelfcast.catalog.series import representative_df
from shelfcast.catalog.sqlparts import exact_mean_sql, split_case
from shelfcast.catalog.windows import TEMPORAL_SQL
from shelfcast.operators import models as mdl
from shelfcast.operators.evaluate import metric_columns, metrics_gap
from shelfcast.operators.profile import clean_columns
from shelfcast.operators.windows import CALENDAR
from shelfcast.plans import train_final as tf
from shelfcast.plans.features import TOXIC_FEATURES
from shelfcast.registry import register
from shelfcast.session import materialize
from shelfcast.sources import fixtures as fx
from shelfcast.sources import sinks
from shelfcast.sources.fixture_sql import with_views
from shelfcast.spec import DEFAULT_SPLIT, HORIZON_DAYS, SHOCK_PERIODS

FEATURES = [c for c in tf.V3_FEATURE_COLS if c != "date"]
H0 = DEFAULT_SPLIT.horizon[0]


# The registered queries fit few and small models, to run in a check; the library's defaults
# are the full numbers (operators.models.TRIALS, ROUNDS).
SMALL = 5
WEIGHTS = (0.3, 0.7)  # fixed values: of the leaf-wise and of the depth-wise booster


def model_table(spark, sf):
    """The v3 feature table in the horizon's mode (calendar lags, store frequencies), written
    once: tree training makes several passes over it."""
    t = tf.safe_feature_set(tf.build_train_final(fx.sales_panel(spark, sf), fx.stores(spark, sf), fx.holidays_events(spark),
                                                 fx.oil(spark, sf), mode=CALENDAR, freq_base="stores"), mode=CALENDAR)
    return materialize(t, "model-table")


def _parts(t):
    return t.where("split = 'train'"), t.where("split = 'val'"), t.where("split in ('val', 'test')")


def _first_model(spark, sf, rounds=SMALL):
    t = model_table(spark, sf)
    train, val, _ = _parts(t)
    return t, mdl.fit_gbt(train, FEATURES, val=val, rounds=rounds, codes_from=t)


@register("gbt_train", None, ids="M-01, V-01")
def gbt_train(spark, sf):
    t, m = _first_model(spark, sf)
    return mdl.predict(m, _parts(t)[2], FEATURES).groupBy("split").agg(*metric_columns("sales", "predicted"))


@register("feature_importance", None, ids="M-04")
def feature_importance(spark, sf):
    _, m = _first_model(spark, sf)
    return mdl.importances(m, FEATURES, spark)


@register("param_search", None, ids="M-02, M-03, V-03")
def param_search(spark, sf, trials: int = 9, rounds: int = 9):
    """Search, refit of the best parameters on train and val, and the gaps to the first model (val and test)."""
    t, first = _first_model(spark, sf, rounds)
    train, val, rest = _parts(t)
    found, best = mdl.search(train, val, FEATURES, trials=trials, rounds=rounds, codes_from=t)
    tuned = mdl.fit_gbt(train.unionByName(val), FEATURES, params=best, rounds=rounds, codes_from=t)
    scores = [mdl.predict(m, rest, FEATURES).groupBy("split").agg(F.lit(name).alias("model"), *metric_columns("sales", "predicted"))
              for name, m in (("baseline", first), ("tuned", tuned))]
    gaps = metrics_gap(scores[0].unionByName(scores[1]))
    return gaps.select("*", F.lit(trials).alias("trials"), F.lit(len(found)).alias("fits"), F.lit(min(e for _, most, e in found if most == rounds)).alias("best_val_rmsle"))


def _boosters(t, rounds=SMALL):
    """The two tuned boosters on train and val, with their weights."""
    both = t.where("split in ('train', 'val')")
    return [(mdl.fit_gbt(both, FEATURES, params=p, rounds=rounds, codes_from=t), w) for p, w in zip((mdl.LGB_TUNED, mdl.XGB_TUNED), WEIGHTS)]


@register("model_roundtrip", None, ids="S-09")
def model_roundtrip(spark, sf):
    t, m = _first_model(spark, sf, rounds=2)
    path = sinks.shared_path(spark, "model")
    m.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    a = mdl.predict(m, t.where("split = 'test'"), FEATURES).select("date", "store_nbr", "family", F.col("predicted").alias("a"))
    b = mdl.predict(loaded, t.where("split = 'test'"), FEATURES).select("date", "store_nbr", "family", F.col("predicted").alias("b"))
    j = a.join(b, ["date", "store_nbr", "family"])
    report = materialize(j.agg(F.count(F.lit(1)).alias("rows"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff")), "roundtrip")
    if (report.first()["max_abs_diff"] or 0.0) != 0.0:
        raise ValueError("the loaded model predicts otherwise than the saved one")
    return report


def future_df(spark, sf):
    return fx.future(spark, sf, H0, HORIZON_DAYS)


def horizon_df(spark, sf):
    return tf.build_horizon_features(fx.sales_panel(spark, sf), fx.stores(spark, sf), fx.holidays_events(spark),
                                     fx.oil(spark, sf), H0, future=future_df(spark, sf))


@register("forecast", None, ids="F-07, M-05, P-22, C-19, U-02, M-03")
def forecast(spark, sf):
    """The blended forecast of every future row, checked like a submission."""
    models = _boosters(model_table(spark, sf))
    h = mdl.blended(models, horizon_df(spark, sf), FEATURES)
    out = materialize(h.select("id", "date", "store_nbr", "family", F.round("predicted", 4).alias("sales")), "forecast")
    mdl.check_submission(out, future_df(spark, sf))
    return out


@register("model_scores", None, ids="V-01, V-02, A-30, TS-15, V-04, M-06")
def model_scores(spark, sf):
    """Test errors of the blend and of the seasonal ARIMA on the representative series (V-04), and
    of the blend on all rows, by day and by holiday (A-30), in one long table."""
    t = model_table(spark, sf)
    models = _boosters(t, rounds=2)
    test = materialize(mdl.blended(models, t.where("split = 'test'"), FEATURES).select("date", "store_nbr", "family", "sales", "predicted"), "test-predictions")
    hd = fx.holidays_events(spark).select("date").distinct().withColumn("_h", F.lit(True))
    score = lambda df, kind, name, pred="predicted": df.groupBy(F.lit(kind).alias("kind"), name.cast("string").alias("name")).agg(*metric_columns("sales", pred))
    rows = [score(test, "blend", F.lit("all rows")), score(test, "blend by day", F.col("date")),
            score(test.join(hd, "date", "left"), "blend by holiday", F.coalesce("_h", F.lit(False)))]
    keys = ["store_nbr", "family"]
    picked = materialize(representative_df(spark, sf).select("pattern", *keys), "representative")
    hist = fx.sales_panel(spark, sf).where(F.col("date") <= F.lit(DEFAULT_SPLIT.val[1])).join(picked.select(*keys), keys, "left_semi")
    first = DEFAULT_SPLIT.test[0]
    arima = mdl.arima_per_series(hist, keys, (DEFAULT_SPLIT.test[1] - first).days + 1)
    arima = arima.withColumn("date", F.date_add(F.lit(first), F.col("h") - 1)).join(test.join(picked, keys), [*keys, "date"])
    rows += [score(arima, "representative blend", F.col("pattern")), score(arima, "representative arima", F.concat_ws(" ", "pattern", "model_order"), "pred")]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@register("arima_per_series", None, ids="M-06")
def arima_per_series(spark, sf):
    hist = fx.sales_panel(spark, sf).where(F.col("date") <= F.lit(DEFAULT_SPLIT.val[1]))
    return mdl.arima_per_series(hist, ["store_nbr", "family"], len(range((DEFAULT_SPLIT.test[1] - DEFAULT_SPLIT.test[0]).days + 1)))


_HLAGS = [14, 16, 21, 28, 35, 364]
_HPART = "PARTITION BY store_nbr, family ORDER BY date RANGE BETWEEN INTERVAL {} DAY PRECEDING AND INTERVAL {} DAY PRECEDING"
R30, R28 = _HPART.format(45, 16), _HPART.format(43, 16)
FUTURE_SQL = f"""SELECT CAST(date + INTERVAL 28 DAY AS DATE) AS date, store_nbr, family, CAST(NULL AS DOUBLE) AS sales, onpromotion
  FROM sales_panel WHERE date BETWEEN DATE '{H0}' - INTERVAL 28 DAY AND DATE '{H0}' - INTERVAL {28 - HORIZON_DAYS + 1} DAY"""


@register("horizon_features", with_views(f"""
WITH fut AS ({FUTURE_SQL}),
u AS (SELECT date, store_nbr, family, sales, onpromotion FROM sales_panel WHERE date >= DATE '{H0}' - INTERVAL 364 DAY AND date < DATE '{H0}'
  UNION ALL SELECT * FROM fut),
lf AS (SELECT u.*, {TEMPORAL_SQL}, """ + ", ".join(f"max(sales) OVER ({_HPART.format(n, n)}) AS lag_{n}" for n in _HLAGS) + f""",
  CASE WHEN count(sales) OVER ({R30}) >= 1 THEN {exact_mean_sql("sales", R30, 4, 6)} END AS rolling_mean_30,
  CASE WHEN count(sales) OVER ({R28}) >= 1 THEN {exact_mean_sql("sales", R28, 4, 6)} END AS rolling_mean_28_safe,
  round(CASE WHEN count(sales) OVER ({R28}) >= 2 THEN stddev_samp(sales) OVER ({R28}) END, 6) AS rolling_std_28_safe FROM u),
fl AS ({FLAGS_SQL.replace("FROM sales_panel p", "FROM fut p")}),
vh AS ({VH}),
halo AS (SELECT d.date,
  COALESCE((SELECT min(vh.date) FROM vh WHERE vh.date > d.date) - d.date, -1) AS days_to_next_holiday,
  COALESCE(d.date - (SELECT max(vh.date) FROM vh WHERE vh.date < d.date), -1) AS days_after_last_holiday
  FROM (SELECT DISTINCT date FROM fut) d),
od AS ({OIL_DAILY_SQL.replace("(SELECT MAX(date) FROM sales_panel)", "(SELECT MAX(date) FROM fut)")}),
se AS (SELECT s.*, CAST(dense_rank() OVER (ORDER BY s.type) - 1 AS INTEGER) AS store_type_encoded FROM stores s),
fte AS (SELECT type, CAST(dense_rank() OVER (ORDER BY type) - 1 AS INTEGER) AS store_type_enc
  FROM (SELECT DISTINCT se.type FROM sales_panel p JOIN se ON se.store_nbr = p.store_nbr)),
cf AS (SELECT city, COUNT(*) / (SELECT COUNT(*)::DOUBLE FROM stores) AS city_freq FROM stores GROUP BY 1),
sf AS (SELECT state, COUNT(*) / (SELECT COUNT(*)::DOUBLE FROM stores) AS state_freq FROM stores GROUP BY 1),
te AS (SELECT store_nbr, family, (SUM(sales) + 10 * (SELECT avg(sales) FROM sales_panel)) / (COUNT(sales) + 10) AS te FROM sales_panel GROUP BY 1, 2)
SELECT lf.* EXCLUDE (sales), fl.is_national_holiday, fl.is_regional_holiday, fl.is_local_holiday, fl.is_transferred_holiday,
  fl.holiday_type, fl.is_carnaval_feature, halo.days_to_next_holiday, halo.days_after_last_holiday,
  CASE WHEN lf.date BETWEEN DATE '{SHOCK_PERIODS[0][0]}' AND DATE '{SHOCK_PERIODS[0][1]}' THEN 1 ELSE 0 END AS is_earthquake_period,
  COALESCE(od.oil_price, (SELECT oil_price FROM od ORDER BY date LIMIT 1)) AS oil_price, od.oil_price_lag_7, od.oil_price_lag_14,
  round(od.oil_price_rolling_mean_28, 6) AS oil_price_rolling_mean_28, round(od.oil_price_change_pct, 6) AS oil_price_change_pct,
  se.type, se.city, se.state, se.cluster, fte.store_type_enc, round(cf.city_freq, 6) AS city_freq, round(sf.state_freq, 6) AS state_freq,
  se.store_type_encoded, CAST(lf.store_nbr AS VARCHAR) || '_' || lf.family AS store_family, round(te.te, 6) AS store_family_te
FROM lf JOIN fl ON fl.date = lf.date AND fl.store_nbr = lf.store_nbr AND fl.family = lf.family
JOIN halo ON halo.date = lf.date LEFT JOIN od ON od.date = lf.date LEFT JOIN se ON se.store_nbr = lf.store_nbr
LEFT JOIN fte ON fte.type = se.type LEFT JOIN cf ON cf.city = se.city LEFT JOIN sf ON sf.state = se.state
LEFT JOIN te ON te.store_nbr = lf.store_nbr AND te.family = lf.family
WHERE lf.date >= DATE '{H0}'"""), ids="F-07, J-04, U-01, C-20")
def horizon_features(spark, sf):
    """All 47 features of the future rows."""
    rounded = ("rolling_mean_30", "rolling_mean_28_safe", "rolling_std_28_safe", "oil_price_rolling_mean_28", "oil_price_change_pct", "store_family_te", "city_freq", "state_freq")
    h = horizon_df(spark, sf).drop("id")
    return h.select(*[F.round(c, 6).alias(c) if c in rounded else F.col(c) for c in h.columns])


@register("union_history_horizon", with_views(f"""
SELECT date, store_nbr, family, sales, false AS is_future FROM sales_panel WHERE date >= DATE '{H0}' - INTERVAL 46 DAY
UNION ALL
SELECT CAST(g.d AS DATE), k.store_nbr, k.family, CAST(NULL AS DOUBLE), true
FROM (SELECT DISTINCT store_nbr, family FROM sales_panel) k
CROSS JOIN LATERAL unnest(generate_series(DATE '{H0}', DATE '{H0}' + INTERVAL {HORIZON_DAYS - 1} DAY, INTERVAL 1 DAY)) AS g(d)"""),
          ids="U-01")
def union_history_horizon(spark, sf):
    p = fx.sales_panel(spark, sf)
    hist = p.where(F.col("date") >= F.date_sub(F.lit(H0), 46)).select("date", "store_nbr", "family", "sales",
                                                                      F.lit(False).alias("is_future"))
    fut = tf.horizon_frame(p, H0).select("date", "store_nbr", "family", F.lit(None).cast("double").alias("sales"),
                                         F.lit(True).alias("is_future"))
    return hist.unionByName(fut)


@register("sink_roundtrip", with_views("""
SELECT store_nbr, CAST(SUM(transactions) AS BIGINT) AS transactions, COUNT(*) AS n_days FROM transactions GROUP BY store_nbr"""), ids="S-06, S-01, S-02")
def sink_roundtrip(spark, sf):
    from pyspark.sql import types as T
    df = fx.transactions(spark, sf)
    path = sinks.write_table(df, sinks.shared_path(spark, "transactions-csv"), fmt="csv")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("store_nbr", T.IntegerType()),
                           T.StructField("transactions", T.LongType())])
    back = sinks.read_typed_csv(spark, path, schema)
    return back.groupBy("store_nbr").agg(F.sum("transactions").alias("transactions"), F.count(F.lit(1)).alias("n_days"))


@register("sink_splits", with_views(f"""
SELECT COALESCE(split, '__none__') AS split, COUNT(*) AS n_rows, MIN(date) AS min_date, MAX(date) AS max_date
FROM (SELECT *, {split_case()} AS split FROM sales_panel) WHERE split IS NOT NULL GROUP BY 1"""), ids="S-07, T-01")
def sink_splits(spark, sf):
    from shelfcast.plans.split import temporal_split
    df = temporal_split(fx.sales_panel(spark, sf))
    path = sinks.write_table(df.sortWithinPartitions("store_nbr", "family", "date"), sinks.shared_path(spark, "splits"),
                             partition_by=["split"])
    back = spark.read.parquet(path)
    return back.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.min("date").alias("min_date"),
                                     F.max("date").alias("max_date"))


@register("sink_verify", with_views("""
SELECT 6 AS n_columns, true AS same_columns, COUNT(*) AS rows_read, COUNT(*) AS rows_expected, true AS same_rows, true AS ok FROM sales_panel"""), ids="S-08")
def sink_verify(spark, sf):
    return sinks.write_verified(fx.sales_panel(spark, sf), sinks.shared_path(spark, "panel"))


@register("scan_typed_csv", with_views("SELECT date, CAST(dcoilwtico AS FLOAT) AS dcoilwtico FROM oil"), ids="S-01, S-05")
def scan_typed_csv(spark, sf):
    from pyspark.sql import types as T
    path = sinks.write_table(fx.oil(spark, sf), sinks.shared_path(spark, "oil-csv"), fmt="csv")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("dcoilwtico", T.FloatType())])
    return sinks.read_typed_csv(spark, path, schema)


@register("scan_narrow", with_views("""
SELECT date, CAST(store_nbr AS SMALLINT) AS store_nbr, family, CAST(sales AS FLOAT) AS sales, CAST(onpromotion AS SMALLINT) AS onpromotion FROM sales_raw"""), ids="S-05, S-01")
def scan_narrow(spark, sf):
    """Sales from a CSV file into the narrow types that hold them, declared at read."""
    from pyspark.sql import types as T
    rows = fx.sales_raw(spark, sf).select("date", "store_nbr", "family", "sales", F.col("onpromotion").cast("int").alias("onpromotion"))
    path = sinks.write_table(rows, sinks.shared_path(spark, "sales-csv"), fmt="csv")
    schema = T.StructType([T.StructField("date", T.DateType()), T.StructField("store_nbr", T.ShortType()), T.StructField("family", T.StringType()),
                           T.StructField("sales", T.FloatType()), T.StructField("onpromotion", T.ShortType())])
    return sinks.read_typed_csv(spark, path, schema)


@register("schema_align", with_views("SELECT is_imputed, onpromotion, sales, family, store_nbr, date FROM sales_panel"), ids="S-04, P-20")
def schema_align(spark, sf):
    p = fx.sales_panel(spark, sf)
    header = p.limit(0).columns[::-1]
    return sinks.align_schema(p, header)


# The contract of the horizon's 47 features. All others are double.
_TEXTS = ["family", "type", "city", "state", "store_family"]
_INTEGERS = ["store_nbr", "year", "month", "day", "day_of_week", "week_of_year", "quarter", "is_weekend", "is_month_start", "is_month_end", "is_payday",
             "is_national_holiday", "is_regional_holiday", "is_local_holiday", "is_transferred_holiday", "holiday_type", "is_carnaval_feature",
             "days_to_next_holiday", "days_after_last_holiday", "is_earthquake_period", "cluster", "store_type_enc", "store_type_encoded"]
HORIZON_TYPES = {c: "date" if c == "date" else "string" if c in _TEXTS else "int" if c in _INTEGERS else "double" for c in tf.V3_FEATURE_COLS}
_HORIZON_NULLABLE = ["oil_price_lag_7", "oil_price_lag_14", "oil_price_rolling_mean_28", "oil_price_change_pct"]


@register("dq_schema_contract", with_views(f"""
WITH fut AS ({FUTURE_SQL}),
u AS (SELECT date, store_nbr, family, sales FROM sales_panel WHERE date >= DATE '{H0}' - INTERVAL 364 DAY AND date < DATE '{H0}' UNION ALL SELECT date, store_nbr, family, sales FROM fut),
l AS (SELECT date, """ + ", ".join(f"max(sales) OVER ({_HPART.format(n, n)}) AS lag_{n}" for n in _HLAGS) + f""" FROM u),
h AS (SELECT * FROM l WHERE date >= DATE '{H0}')
""" + " UNION ALL ".join(f"SELECT 'lag_{n}' AS column, 'double' AS type, 'double' AS expected_type, COUNT(*) AS n_rows, COUNT(*) FILTER (WHERE lag_{n} IS NULL) AS nulls, COUNT(*) FILTER (WHERE lag_{n} IS NULL) = 0 AS ok FROM h" for n in _HLAGS)), ids="C-17, U-05")
def dq_schema_contract(spark, sf):
    """Names and types of all 47 features are held against the contract; the report is of the lags' rows (lag_14 isn't known from the 15th day on)."""
    h = horizon_df(spark, sf)
    return sinks.schema_contract(h, HORIZON_TYPES, TOXIC_FEATURES, _HORIZON_NULLABLE).where(F.col("column").startswith("lag_"))


@register("clean_columns", with_views("SELECT date, store_nbr, transactions FROM transactions"), ids="C-04")
def clean_columns_q(spark, sf):
    t = fx.transactions(spark, sf).toDF(" date", "store_nbr ", " transactions ")
    return clean_columns(t, ["date", "store_nbr", "transactions"])

