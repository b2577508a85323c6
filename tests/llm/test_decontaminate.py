import random

import numpy as np
from helpers import contamination as brute
from helpers import docs

from shelfcast.llm.decontaminate import contamination, decontaminate, winnow, winnow_all


def items(spark, rows):
    return spark.createDataFrame([(i, t, 1) for i, t in rows], "item_id long, text string, hits int")


def cases():
    rng = random.Random(5)
    some = lambda n, v: " ".join(f"w{rng.randrange(v)}" for _ in range(n))
    bench = [(k, some(rng.choice([13, 14, 20, 40]), 30)) for k in range(20)]
    bench += [(50, "one two three"), (51, "Lone"), (52, ""), (53, None), (54, "?!"), (3, bench[3][1]), (60, bench[4][1]), (None, "alpha beta gamma delta")]
    texts = []
    for k in range(60):
        t = some(rng.randrange(0, 80), 30)
        if k % 3 == 0:
            w = bench[k % 20][1].split()
            a = rng.randrange(len(w))
            t += " — " + ", ".join(x.upper() for x in w[a : a + rng.randrange(1, 30)]) + " " + some(9, 30)
        texts.append((k, t))
    texts += [(100, None), (101, ""), (102, " .,"), (None, bench[0][1]), (None, "clean text"), (103, bench[1][1]), (103, bench[1][1]), (104, bench[2][1] + " " + some(30000, 10**6)), (105, "One, two THREE one two"), (106, "lone"), (107, "Ünï lone çé 漢字 one two"), (108, "alpha beta gamma delta")]
    return texts, bench


def test_against_brute_force(spark):
    texts, bench = cases()
    found = contamination(docs(spark, texts), items(spark, bench)).collect()
    want = sorted((str(i), *brute(t, bench)) for i, t in texts)
    assert sorted((str(r["doc_id"]), *r[1:]) for r in found) == want
    assert any(w[-1] for w in want) and not all(w[-1] for w in want)


def test_filter_keeps_columns_and_clean_rows(spark):
    texts, bench = cases()
    kept = decontaminate(docs(spark, texts), items(spark, bench))
    assert kept.columns == docs(spark, []).columns
    assert sorted((str(r["doc_id"]), str(r["text"])) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in texts if not brute(t, bench)[-1])


def test_empty_tables(spark):
    assert contamination(docs(spark, []), items(spark, [(1, "a b")])).count() == 0
    (row,) = contamination(docs(spark, [(1, "a b")]), items(spark, [])).collect()
    assert (row["n_words"], row["n_hit"], row["n_items"], row["contaminated"]) == (2, 0, 0, False)


def test_winnowing_of_many_texts_is_that_of_each():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 4, 5, 12, 13, 14, 200]
    words = np.concatenate([[0], np.cumsum(sizes)])
    grams = rng.integers(0, 6, words[-1]).astype(np.uint64)  # many ties
    want = [a + p for a, n in zip(words, sizes, strict=False) if n - 4 >= 9 for p in winnow(grams[a : a + n - 4], 9)]
    assert winnow_all(grams, words, 5, 9).tolist() == want
