"""Transaction cleaning on dirty input (bad date, text number, negative count, duplicate key)."""

import math

import pytest

from shelfcast.operators import encoders as enc
from shelfcast.plans.cleaning import clean_transactions


def test_clean_transactions_dirty_rows(spark):
    raw = spark.createDataFrame([
        ("2017-01-01", "1", "10"),
        ("2017-01-01", "1", "5"),        # duplicate key: summed
        ("not a date", "1", "3"),        # dropped
        ("2017-01-02", "x", "3"),        # bad store: dropped
        ("2017-01-02", "2", "-4"),       # negative: dropped
        ("2017-01-03", "2", "7.9"),      # text number: parsed, truncated to 7
    ], " date , store_nbr,transactions ".split(","))
    out = {(r.date, r.store_nbr): r for r in clean_transactions(raw).collect()}
    assert len(out) == 6  # 3 days x 2 stores
    assert out[("2017-01-01", 1)].transactions == 15 and out[("2017-01-01", 1)].is_imputed == 0
    assert out[("2017-01-02", 2)].transactions == 0 and out[("2017-01-02", 2)].is_imputed == 1
    assert out[("2017-01-03", 2)].transactions == 7


def test_missing_required_column_raises(spark):
    raw = spark.createDataFrame([("2017-01-01", "1")], ["date", "store_nbr"])
    with pytest.raises(ValueError):
        clean_transactions(raw)


def test_sigmoid_blend_and_unseen_prior(spark):
    train = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "k string, y double")
    m = enc.target_encode_fit(train, "k", "y", how=enc.SIGMOID, k=1.0, s=1.0)
    test = spark.createDataFrame([("a",), ("z",)], "k string")
    out = {r.k: r.k_te for r in enc.target_encode_apply(test, m, "k", "k_te").collect()}
    prior = 14.0 / 3
    w = 1 / (1 + math.exp(-(2 - 1.0) / 1.0))
    assert out["a"] == pytest.approx(w * 2.0 + (1 - w) * prior)
    assert out["z"] == pytest.approx(prior)
