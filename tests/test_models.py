"""Training and horizon features agree; submission checks; search ranges; blend."""

import datetime as dt
import math
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F

from shelfcast.operators import models as mdl
from shelfcast.operators.windows import CALENDAR
from shelfcast.plans import train_final as tf
from shelfcast.sources import fixtures as fx
from shelfcast.spec import HORIZON_DAYS


def test_training_and_horizon_features_agree_on_days_with_gaps(spark):
    start = dt.date(2001, 10, 10)
    end = start + dt.timedelta(days=HORIZON_DAYS - 1)
    panel = fx.sales_gappy(spark, SF).where((F.dayofyear("date") % 11 != 3) & (F.col("date") <= F.lit(end)))
    dims = (fx.stores(spark, SF), fx.holidays_events(spark), fx.oil(spark, SF))
    train = tf.add_v3_features(tf.build_train_final(panel, *dims, mode=CALENDAR, freq_base="stores"), mode=CALENDAR)
    future = panel.where(F.col("date") >= F.lit(start)).select("date", "store_nbr", "family", "onpromotion", F.lit("kept").alias("tag"))
    horizon = tf.build_horizon_features(panel.where(F.col("date") < F.lit(start)), *dims, start, future=future)
    assert horizon.columns == ["tag", *tf.V3_FEATURE_COLS] and len(tf.V3_FEATURE_COLS) == 47
    same = [c for c in tf.V3_FEATURE_COLS if c != "store_family_te"]  # fitted out of fold in training only
    # two weeks back lies in the horizon itself for its last days
    known = F.when(F.col("date") < F.date_add(F.lit(start), 14), F.col("lag_14"))
    train, horizon = train.withColumn("lag_14", known), horizon.withColumn("lag_14", known)
    a = train.where(F.col("date") >= F.lit(start)).select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in train.select(*same).dtypes])
    b = horizon.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in horizon.select(*same).dtypes])
    rows = sorted(map(str, a.collect()))
    assert rows == sorted(map(str, b.collect())) and len(rows) == future.count() > 500
    assert horizon.where("store_family_te is null").count() == 0


def test_submission_checks(spark):
    future = spark.createDataFrame([("a",), ("b",)], "id string")
    good = spark.createDataFrame([("a", 0.0), ("b", 2.0)], "id string, sales double")
    mdl.check_submission(good, future)
    for bad in ([("a", 1.0)], [("a", 1.0), ("a", 2.0)], [("a", None), ("b", 1.0)], [("a", -0.1), ("b", 1.0)]):
        with pytest.raises(ValueError):
            mdl.check_submission(spark.createDataFrame(bad, "id string, sales double"), future)


def test_search_draws_from_the_ranges():
    rng = random.Random(1)
    for _ in range(200):
        p = mdl.sample_params(mdl.SEARCH_SPACE, rng)
        for name, (_, low, high) in mdl.SEARCH_SPACE.items():
            assert low - 1e-4 <= float(p[name]) <= high + 1e-4
    assert (mdl.TRIALS, mdl.ROUNDS) == (45, 1000)


def test_fit_stop_and_blend(spark):
    rows = [(float(k % 50), "ab"[k % 2], float(k % 50) + 10 * (k % 2), k % 5 == 0) for k in range(600)]
    df = spark.createDataFrame(rows, "x double, c string, sales double, held boolean").withColumn("sales_log", F.log1p("sales"))
    train, val = df.where("not held").drop("held"), df.where("held").drop("held")
    params = {"minInstancesPerNode": 2, "maxDepth": 4}
    a = mdl.fit_gbt(train, ["x", "c"], val=val, params=params, rounds=8, codes_from=df)
    b = mdl.fit_gbt(train, ["x", "c"], params=params, rounds=3)
    assert 1 <= a.stages[-1].getNumTrees <= 8
    out = mdl.blended([(a, 0.3), (b, 0.7)], val, ["x", "c"]).collect()
    one, two = ({(r["x"], r["c"]): r["pred_log"] for r in mdl.predict(m, val, ["x", "c"]).collect()} for m in (a, b))
    for r in out:
        assert r["predicted"] == pytest.approx(max(math.expm1(0.3 * one[r["x"], r["c"]] + 0.7 * two[r["x"], r["c"]]), 0.0))


def test_successive_halving(spark):
    assert mdl.rungs(45, 1000) == [(45, 37), (15, 111), (5, 333), (1, 1000)] and mdl.rungs(9, 9) == [(9, 1), (3, 3), (1, 9)]
    assert mdl.rungs(1, 50) == [(1, 50)] and mdl.rungs(20, 1) == [(20, 1)] and mdl.rungs(2, 9) == [(2, 9)]
    rows = [(float(k * 37 % 101) if k % 17 else None, "ab"[k % 2], float(k * 37 % 101) ** 2 + 10 * (k % 2), k % 5 == 0) for k in range(500)]
    df = spark.createDataFrame(rows, "x double, c string, sales double, held boolean").withColumn("sales_log", F.log1p("sales"))
    train, val = df.where("not held").drop("held"), df.where("held").drop("held")
    matrix = mdl.search_matrix(train, val, ["x", "c"], bins=8)
    bins = {r["features"][1] for r in matrix.collect()}
    assert matrix.count() == 500 and bins == set(map(float, range(len(bins)))) and 7 <= len(bins) <= 8
    space = {**mdl.SEARCH_SPACE, "minInstancesPerNode": ("int", 2, 40)}
    found, best = mdl.search(train, val, ["x", "c"], trials=6, rounds=4, eta=2, space=space, codes_from=df)
    assert [m for _, m, _ in found] == [1] * 6 + [2] * 3 + [4]
    rng = random.Random(42)
    assert [p for p, _, _ in found[:6]] == [mdl.sample_params(space, rng) for _ in range(6)]
    order = sorted(found[:6], key=lambda x: x[2])
    assert [p for p, _, _ in found[6:9]] == [p for p, _, _ in order[:3]] and best == min(found[6:9], key=lambda x: x[2])[0] == found[9][0]
    again, _ = mdl.search(train, val, ["x", "c"], trials=6, rounds=4, eta=2, space=space, codes_from=df, parallel=1)
    assert [(p, m) for p, m, _ in again] == [(p, m) for p, m, _ in found] and [e for *_, e in again] == pytest.approx([e for *_, e in found])


def test_small_steps_do_not_stop_boosting(spark):
    df = spark.createDataFrame([(float(k % 97), float(k % 89), k % 4 == 0) for k in range(800)], "x double, y double, held boolean")
    df = df.withColumn("sales", F.col("x") * F.col("y")).withColumn("sales_log", F.log1p("sales"))
    train, val = df.where("not held").drop("held"), df.where("held").drop("held")
    params = {"stepSize": 0.02, "maxDepth": 3, "minInstancesPerNode": 2, "subsamplingRate": 1.0}
    assert mdl.fit_gbt(train, ["x", "y"], val=val, params=params, rounds=6).stages[-1].getNumTrees == 6
    found, _ = mdl.search(train, val, ["x", "y"], trials=1, rounds=6, space={**mdl.SEARCH_SPACE, "stepSize": ("float", 0.02, 0.02), "minInstancesPerNode": ("int", 2, 2)})
    one, _ = mdl.search(train, val, ["x", "y"], trials=1, rounds=1, space={**mdl.SEARCH_SPACE, "stepSize": ("float", 0.02, 0.02), "minInstancesPerNode": ("int", 2, 2)})
    assert found[0][2] < one[0][2]
