import random

from shelfcast.llm.flags import without


def test_without_against_sets(spark):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(300)]), rng.choice(["a", "b", None]), k, "w", 1) for k in range(2000)]
    gone = [(rng.choice([None, *range(300)]), rng.choice(["a", "b", None])) for _ in range(200)]
    frame = spark.createDataFrame(rows, "x long, y string, n int, flag_word string, flag_bits int")
    for bits in (26, 12, 6):  # at 6, nearly all rows are looked up
        kept = without(frame, spark.createDataFrame(gone * 2, "x long, y string"), ["x", "y"], most_bits=bits)
        assert kept.columns == frame.columns
        assert sorted(r["n"] for r in kept.collect()) == [r[2] for r in rows if r[:2] not in set(gone)]
    assert without(frame, spark.createDataFrame([], "x long, y string"), ["x", "y"]).count() == 2000
