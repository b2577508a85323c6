import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs, jaccard_components, shingles

from shelfcast.llm import forest
from shelfcast.llm.jaccard import Similarity
from shelfcast.llm.textbytes import shingle_sets

LIKE = Similarity(3, 85, 100)


def some(rng, n, of=4000):
    return [f"v{rng.randrange(of)}" for _ in range(n)]


def cases():
    rng = random.Random(12)
    rows, line = [], some(rng, 40)
    for k in range(60):  # documents that share a passage but aren't alike
        rows.append((k, " ".join(some(rng, 60) + line + some(rng, 60))))
    base = some(rng, 150)
    for k in range(100, 220):  # near copies of one text, of different distances
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(9999)}"
        rows.append((k, " ".join(w)))
    chain = some(rng, 120)
    for k in range(300, 312):  # each is near the one before it only
        chain = chain[4:] + some(rng, 4)
        rows.append((k, "\n".join(chain)))
    rows += [(400 + k, t) for k, t in enumerate(["a b c", "A  b\tc", "a b", "a b", "a", "", None, " \n", "a b c d", "a b c d e"])]
    rows += [(5, rows[5][1]), (410, rows[7][1]), (410, rows[70][1]), (None, rows[70][1]), (None, None), (500, " ".join(some(rng, 50000))), (501, rows[0][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("leaf", [16, 2])
def test_against_brute_force(spark, leaf):
    rows = cases()  # at leaf=2, the near copies are crowded regions of the full depth
    want = jaccard_components(rows, 3, 85, 100)
    found = forest.near_duplicates(docs(spark, rows), LIKE, leaf=leaf).collect()
    expect = [f"Row(doc_id={i}, n_shingles={len(shingles(t, 3))}, component_id={want.get(i)}, kept={i is None or want[i] == i})" for i, t in rows]
    assert sorted(map(str, found)) == sorted(expect)


def test_blocks_of_crowded_regions_connect_what_neighbours_do_not(spark):
    rng = random.Random(4)
    base, rows = some(rng, 200), []
    for k in range(150):  # copies that link with few others
        w = list(base)
        for j in rng.sample(range(200), 6):
            w[j] = f"x{rng.randrange(9999)}"
        rows.append((k, " ".join(w)))
    want = jaccard_components(rows, 3, 85, 100)
    found = {r["doc_id"]: r["component_id"] for r in forest.near_duplicates(docs(spark, rows), LIKE, leaf=3).collect()}
    assert found == want


def test_signatures_are_the_smallest_hashes():
    sets = list(shingle_sets(pa.array(["a b c d e f", "g", "h i j k l m n o"]), 2))
    found = forest.signatures(sets, tokens=4)
    for s, row in zip(sets, found, strict=True):
        for factor, value in zip(forest.FACTORS, row, strict=True):
            least = min(int(t) * int(factor) % 2**64 for t in s)
            assert value == (least * int(forest.SPREAD) % 2**64) >> 32


def test_similar_sets_share_a_label_of_the_full_depth():
    rng, missed = np.random.default_rng(3), 0
    for _ in range(200):
        shared = rng.integers(0, 2**63, 170, dtype=np.uint64)
        sides = [np.concatenate([shared, rng.integers(0, 2**63, 15, dtype=np.uint64)]) for _ in "ab"]  # 0.85
        a, b = forest.signatures(sides).reshape(2, forest.TREES, -1)
        missed += not (a == b).all(1).any()
        assert np.count_nonzero((a & 1) != (b & 1)) <= forest.furthest(LIKE)
    assert missed == 0


def test_empty_table(spark):
    assert forest.near_duplicates(docs(spark, [])).count() == 0
    assert [tuple(r) for r in forest.near_duplicates(docs(spark, [(None, None), (1, None)])).orderBy("doc_id").collect()] == [(None, 0, None, True), (1, 0, 1, True)]
