"""Exact quantiles by selection, ranks and running sums in two levels, stored aggregates, the horizon's state, checked writing."""

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfcast.operators.quantiles import summarize
from shelfcast.operators.ranks import average_rank, running
from shelfcast.operators.recent import lag_at, recent_days, rolling_at
from shelfcast.plans.cleaning import split_valid
from shelfcast.session import scratch_path
from shelfcast.sources import segments, sinks
from shelfcast.spec import PanelSpec

PROBS = [0.0, 0.01, 0.25, 0.5, 0.77, 0.99, 1.0]


@pytest.mark.parametrize("few,fine", [(50_000, 1 << 14), (3, 4), (1, 2)])
def test_quantiles_and_moments_against_numpy(spark, few, fine):
    rng = np.random.default_rng(1)
    columns = {
        "mixed": np.concatenate([rng.normal(0, 1e6, 400), np.zeros(150), rng.normal(0, 1e-6, 100), np.full(80, 7.25)]),
        "money": np.round(rng.gamma(2, 50, 730), 2), "same": np.full(730, -3.5), "huge": rng.normal(0, 1, 730) * 10.0 ** rng.integers(-300, 300, 730),
    }
    frame = pd.DataFrame(columns).assign(few=[1.0, 4.0] + [None] * 728, none=[None] * 730)
    df = spark.createDataFrame(frame, "mixed double, money double, same double, huge double, few double, none double").repartition(5)
    df = df.unionByName(spark.createDataFrame([(float("nan"),)], "mixed double"), allowMissingColumns=True)
    found = summarize(df, dict.fromkeys([*columns, "few", "none"], PROBS), few, fine)
    for name, values in {**columns, "few": np.array([1.0, 4.0])}.items():
        s = found[name]
        assert s.count == len(values) and s.min == values.min() and s.max == values.max()
        assert s.quantiles == pytest.approx(np.quantile(values, PROBS).tolist(), rel=1e-12)
        if name != "huge":  # the squares of its values are no numbers
            assert s.mean == pytest.approx(values.mean(), rel=1e-9, abs=1e-9) and s.std == pytest.approx(values.std(ddof=1), rel=1e-9, abs=1e-12)
    assert found["none"].count == 0 and found["none"].mean is None and found["none"].quantiles == [None] * len(PROBS)


def test_running_sums_and_positions(spark):
    rng = random.Random(2)
    rows = [(k, rng.randrange(50), rng.choice([None, 0.1, 2.5, -1.0])) for k in range(3000)]
    df = spark.createDataFrame(rows, "id int, a int, v double").repartition(16)
    found = {r["id"]: r for r in running(df, [F.col("a").desc(), "id"], {"cum": "v", "seen": "id"}).collect()}
    total = seen = 0.0
    for place, (i, a, v) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0]))):
        total, seen = total + (v or 0), seen + i
        r = found[i]
        assert (r["row_pos"], r["seen"]) == (place, seen) and r["cum"] == pytest.approx(total, abs=1e-6)
    empty = running(df.where("id < 0"), ["a"], {"cum": "v"})
    assert empty.count() == 0 and empty.columns == ["id", "a", "v", "row_pos", "cum"]


def test_ranks_of_a_million_keys_with_ties(spark):
    df = spark.range(1_000_000).select("id", F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") % 1000).cast("double")).alias("v"))
    r = average_rank(df, "v", "rank", desc=False).groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("a"), F.max("rank").alias("b")).orderBy("v").collect()
    before = 0
    for row in r:
        assert row["a"] == row["b"] == before + (row["n"] + 1) / 2
        before += row["n"]
    assert before == 1_000_000


def test_average_ranks_within_groups(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice("xyz") if k % 9 else None, rng.choice([None, 1.0, 2.0, 2.5])) for k in range(200)]
    found = {r["id"]: r["rank"] for r in average_rank(spark.createDataFrame(rows, "id int, g string, v double"), "v", "rank", ["g"]).collect() if r["v"] is not None}
    frame = pd.DataFrame(rows, columns=["id", "g", "v"])
    want = frame.groupby("g", dropna=False)["v"].rank(ascending=False)
    assert len(found) == frame["v"].notna().sum()
    for i, rank in found.items():
        if rows[i][1] is not None:
            assert rank == want[i]


def test_stored_aggregates_follow_their_input(spark):
    top = scratch_path(spark, "input")
    spark.range(5).write.parquet(f"{top}/t.parquet")
    runs = []
    build = lambda: (runs.append(1), spark.read.parquet(f"{top}/t.parquet").agg(F.count(F.lit(1)).alias("n")))[1]
    assert segments.stored(spark, top, "count", ("t",), build).first()["n"] == 5
    assert segments.stored(spark, top, "count", ("t",), build).first()["n"] == 5 and len(runs) == 1
    spark.range(2).write.mode("append").parquet(f"{top}/t.parquet")
    assert segments.stored(spark, top, "count", ("t",), build).first()["n"] == 7 and len(runs) == 2


@pytest.mark.parametrize("decimals", [4, None])
def test_horizon_state_against_plain_lags(spark, decimals):
    rng, start = random.Random(4), dt.date(2001, 3, 1)
    days = {s: {start - dt.timedelta(days=b): round(rng.random() * 100, 4) for b in range(-3, 400) if rng.random() < 0.8} for s in (1, 2)}  # gaps; days of the horizon don't count
    rows = [(s, d, v) for s, of in days.items() for d, v in of.items()]
    spec = PanelSpec(keys=("s",), target="v", decimals=decimals)
    state = recent_days(spark.createDataFrame(rows, "s int, date date, v double"), start, 364, spec)
    future = spark.createDataFrame([(s, start + dt.timedelta(days=k)) for s in (1, 2, 3) for k in range(16)], "s int, date date").join(state, "s", "left")
    ahead = F.datediff("date", F.lit(start))
    out = future.select("s", "date", *(lag_at("recent", ahead, n).alias(f"l{n}") for n in (1, 14, 16, 364)), *(rolling_at("recent", ahead, 28, o, st, m, decimals).alias(f"{st}{o}") for o in (1, 16) for st, m in (("mean", 1), ("std", 2))))
    for r in out.collect():
        known = {d: v for d, v in days.get(r["s"], {}).items() if d < start}
        at = lambda n: known.get(r["date"] - dt.timedelta(days=n))  # noqa: B023, E731
        assert [r[f"l{n}"] for n in (1, 14, 16, 364)] == [at(n) for n in (1, 14, 16, 364)]
        for o in (1, 16):
            values = [v for n in range(o, o + 28) if (v := at(n)) is not None]
            assert r[f"mean{o}"] == (pytest.approx(np.mean(values), abs=1e-8) if values else None)
            assert r[f"std{o}"] == (pytest.approx(np.std(values, ddof=1)) if len(values) > 1 else None)


def test_written_rows_are_counted_and_compared(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "x int, y string")
    assert tuple(sinks.write_verified(df, scratch_path(spark, "w")).first()) == (2, True, 3, 3, True, True)
    assert tuple(sinks.write_verified(df, scratch_path(spark, "w"), "csv").first())[2:] == (3, 3, None, True)
    assert sinks.write_verified(df.limit(0), scratch_path(spark, "w")).first()["ok"]


def test_contract_on_rows(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (2, None, None)], "x int, y string, z double")
    found = {r["column"]: (r["n_rows"], r["nulls"], r["ok"]) for r in sinks.schema_contract(df, {"x": "int", "y": "string", "z": "double"}, nullable=["z"]).collect()}
    assert found == {"x": (2, 0, True), "y": (2, 1, False), "z": (2, 1, True)}
    for expected, removed in (({"w": "int"}, []), ({"x": "bigint"}, []), ({"x": "int"}, ["z"])):
        with pytest.raises(ValueError):
            sinks.schema_contract(df, expected, removed)


def test_cleaning_keeps_every_row_on_one_side(spark):
    rows = [("2001-01-01", "1", "5"), (" 2001-01-02 ", "1.0", " 7.0"), ("2001-02-30", "1", "5"), (None, "1", "5"), ("2001-01-01", "S1", "5"), ("2001-01-01", "1.5", "5"), ("2001-01-01", None, "x"), ("2001-01-01", "1", "x"), ("2001-01-01", "1", "2.5"), ("2001-01-01", "1", "-2"), ("2001-01-01", "1", "NaN"), ("2001-01-01", "1", None)]
    got = split_valid(spark.createDataFrame(rows, " date string, store_nbr string, transactions string"))
    assert got.counts == {"rows": 12, "accepted": 2, "bad date": 2, "bad store": 3, "bad count": 4, "negative count": 1}
    assert sorted(map(tuple, got.rows.collect())) == [(dt.date(2001, 1, 1), 1, 5), (dt.date(2001, 1, 2), 1, 7)]
    assert got.rejects.groupBy("reason").count().count() == 4 and got.rejects.count() == 10
