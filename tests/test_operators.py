"""Unit tests of operators on hand-made mock panels (the reference's smoke shapes and edge cases)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import encoders as enc
from shelfcast.operators.panel import complete_panel, ffill_bfill, interpolate_linear
from shelfcast.operators.windows import CALENDAR, ROWS, lag_col, rolling_col
from shelfcast.plans.features import add_safe_features
from shelfcast.plans.holidays import add_holiday_flags, holiday_halo
from shelfcast.sources.fixtures import HOLIDAY_SCHEMA
from shelfcast.spec import PanelSpec

D0 = dt.date(2017, 1, 1)


def _panel(spark, rows):
    return spark.createDataFrame(rows, "date date, store_nbr int, family string, sales double")


def test_row_vs_calendar_lag_on_gap(spark):
    rows = [(D0 + dt.timedelta(days=i), 1, "G", float(i)) for i in range(10) if i != 4]
    df = _panel(spark, rows)
    out = {r.date: r for r in df.select("date", lag_col("sales", 1).alias("r"),
                                        lag_col("sales", 1, mode=CALENDAR).alias("c")).collect()}
    d5 = D0 + dt.timedelta(days=5)
    assert out[d5].r == 3.0  # previous row
    assert out[d5].c is None  # the calendar day before is missing


def test_series_isolation_and_first_lag_null(spark):
    rows = [(D0 + dt.timedelta(days=i), s, "G", float(10 * s + i)) for s in (1, 2) for i in range(60)]
    df = _panel(spark, rows)
    r = df.select("store_nbr", "date", lag_col("sales", 1).alias("lag_1"),
                  rolling_col("sales", 7, 1, "mean", 1).alias("rm7")).where(F.col("date") == D0).collect()
    assert all(x.lag_1 is None and x.rm7 is None for x in r)
    only1 = _panel(spark, [x for x in rows if x[1] == 1])
    a = df.where("store_nbr = 1").select("date", rolling_col("sales", 28, 16, "mean", 1).alias("v"))
    b = only1.select("date", rolling_col("sales", 28, 16, "mean", 1).alias("v"))
    assert sorted(a.collect()) == sorted(b.collect())


def test_rolling_min_periods_and_std(spark):
    rows = [(D0 + dt.timedelta(days=i), 1, "G", float(i)) for i in range(5)]
    df = _panel(spark, rows)
    r = {x.date: x for x in df.select("date", rolling_col("sales", 7, 1, "std", 2).alias("s"),
                                      rolling_col("sales", 7, 1, "mean", 1).alias("m")).collect()}
    assert r[D0 + dt.timedelta(days=1)].s is None  # one value in frame, min_periods 2
    assert r[D0 + dt.timedelta(days=2)].s == pytest.approx(0.7071067811865476)
    assert r[D0 + dt.timedelta(days=3)].m == pytest.approx(1.0)


def test_shift_safety(spark):
    """Changing sales after day d never changes a safe feature on any day up to d + 16."""
    rows = [(D0 + dt.timedelta(days=i), 1, "G", float(i % 7)) for i in range(120)]
    d = D0 + dt.timedelta(days=60)
    changed = [(a, b, c, v + 100.0 if a > d else v) for a, b, c, v in rows]
    cols = ["lag_16", "lag_21", "lag_35", "rolling_mean_30", "rolling_mean_28_safe", "rolling_std_28_safe"]
    f1 = add_safe_features(_panel(spark, rows)).where(F.col("date") <= d + dt.timedelta(days=16)).select("date", *cols)
    f2 = add_safe_features(_panel(spark, changed)).where(F.col("date") <= d + dt.timedelta(days=16)).select("date", *cols)
    assert sorted(f1.collect()) == sorted(f2.collect())


def test_complete_panel_and_fills(spark):
    df = spark.createDataFrame([(D0, 1, 5.0), (D0 + dt.timedelta(days=3), 1, 8.0), (D0 + dt.timedelta(days=1), 2, 1.0)],
                               "date date, store_nbr int, v double")
    p = complete_panel(df, PanelSpec(keys=("store_nbr",), target="v"), fill={"v": 0.0})
    assert p.count() == 8
    assert p.where("is_imputed = 1").count() == 5
    g = complete_panel(df.where("store_nbr = 1").drop("store_nbr"), PanelSpec(keys=(), target="v"), flag_col=None)
    i = {r.date: r.v for r in interpolate_linear(g, "v").collect()}
    assert i[D0 + dt.timedelta(days=1)] == pytest.approx(6.0)
    f = {r.date: r.v for r in ffill_bfill(g, ["v"]).collect()}
    assert f[D0 + dt.timedelta(days=2)] == 5.0


def test_kfold_layout(spark):
    df = spark.range(11).withColumnRenamed("id", "k")
    f = enc.kfold_contiguous(df, ["k"], 5)
    sizes = sorted(((r.fold, r["count"]) for r in f.groupBy("fold").count().collect()))
    assert [s for _, s in sizes] == [3, 2, 2, 2, 2]
    assert [r.row_pos for r in f.orderBy("k").collect()] == list(range(11))


def test_target_encode_oof_totals(spark):
    df = spark.createDataFrame([(0, "a", 1.0), (0, "b", 3.0), (1, "a", 5.0), (1, "b", 7.0)], "fold int, key string, y double")
    out = {(r.fold, r.key): r.key_te for r in enc.target_encode_oof(df, "key", "y", "fold").collect()}
    # fold 0, key a: other folds have one 'a' = 5.0; prior outside fold 0 = (5+7)/2 = 6
    assert out[(0, "a")] == pytest.approx((1 * 5.0 + 10 * 6.0) / 11)


def test_holiday_last_row_wins_and_halo(spark):
    h = spark.createDataFrame([
        (1, dt.date(2017, 1, 2), "Holiday", "National", "Country", "x", False),
        (2, dt.date(2017, 1, 2), "Transfer", "Local", "Q", "Carnaval day", False),
        (3, dt.date(2017, 1, 5), "Holiday", "National", "Country", None, True),
    ], HOLIDAY_SCHEMA)
    stores = spark.createDataFrame([(1, "Q", "P"), (2, "R", "P")], "store_nbr int, city string, state string")
    fact = spark.createDataFrame([(dt.date(2017, 1, 2), 1), (dt.date(2017, 1, 2), 2)], "date date, store_nbr int")
    r = {x.store_nbr: x for x in add_holiday_flags(fact, stores, h).collect()}
    assert r[1].holiday_type == 4 and r[1].is_carnaval_feature == 1 and r[1].is_local_holiday == 1
    assert r[2].holiday_type == 1 and r[2].is_carnaval_feature == 0 and r[2].is_national_holiday == 1
    dates = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2017, 1, 2),), (dt.date(2017, 1, 4),)], "date date")
    halo = {x.date: x for x in holiday_halo(dates, h).collect()}
    assert halo[dt.date(2017, 1, 1)].days_to_next_holiday == 1
    assert halo[dt.date(2017, 1, 2)].days_to_next_holiday == -1  # transferred row is not valid; strict inequality
    assert halo[dt.date(2017, 1, 4)].days_after_last_holiday == 2
