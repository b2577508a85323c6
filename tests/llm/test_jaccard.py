import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, docs, jaccard_components, shingles

from shelfcast.llm import jaccard
from shelfcast.llm.components import connected
from shelfcast.llm.textbytes import shingle_sets


def cases():
    rng = random.Random(11)
    some = lambda n: [f"v{rng.randrange(4000)}" for _ in range(n)]
    rows, line = [], some(40)
    for k in range(60):  # documents that share a passage but aren't alike
        rows.append((k, " ".join(some(60) + line + some(60))))
    base = some(150)
    for k in range(100, 180):  # near copies of one text, of different distances
        w = list(base)
        for _ in range(rng.randrange(0, 7)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(999)}"
        rows.append((k, " ".join(w)))
    chain = some(120)
    for k in range(200, 212):  # each is near the one before it only
        chain = chain[3:] + some(3)
        rows.append((k, "\n".join(chain)))
    rows += [(300 + k, t) for k, t in enumerate(["a b c", "A  b\tc", "a b", "a b", "", None, " \n", "a b c d", "a b c d e"])]
    rows += [(5, rows[5][1]), (310, rows[7][1]), (310, rows[70][1]), (None, rows[70][1]), (None, None), (400, " ".join(some(50000))), (401, rows[0][1].upper())]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("like", [jaccard.Similarity(4, 85, 100), jaccard.Similarity(5, 8, 10)])
@pytest.mark.parametrize("group_tokens", [1 << 16, 400])
def test_against_brute_force(spark, like, group_tokens):
    rows = cases()
    want = jaccard_components(rows, like.words, like.num, like.den)
    found = jaccard.jaccard_components(docs(spark, rows), like, group_tokens=group_tokens, common_least=3).collect()
    assert sorted(map(str, found)) == sorted(f"Row(doc_id={i}, n_shingles={len(shingles(t, like.words))}, component_id={want.get(i)})" for i, t in rows)


@pytest.mark.parametrize("num,den,small", [(85, 100, 35), (8, 10, 33)])
def test_groups_of_mixed_sizes_at_the_threshold(spark, num, den, small):
    names = [f"w{k}" for k in range(400)]
    names = [names[k] for k in np.argsort([next(shingle_sets(pa.array([n]), 1))[0] for n in names])]  # in the order of tokens
    rows = []
    for k in range(4):  # sets of 39 and 40 tokens are one group; `small` shares all its tokens but one with the first
        own, shared = names[k * 100 : k * 100 + 40 - small + 1], names[k * 100 + 50 : k * 100 + 50 + small - 1]
        a = own[: 39 - len(shared)] + shared
        rows += [(10 * k, " ".join([*shared, names[k * 100 + 99]])), (10 * k + 1, " ".join(a)), (10 * k + 2, " ".join([own[39 - len(shared)], *a]))]
    want = jaccard_components(rows, 1, num, den)
    assert all(want[10 * k + j] == 10 * k for k in range(4) for j in range(3))
    found = jaccard.jaccard_components(docs(spark, rows), jaccard.Similarity(1, num, den)).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == want


@pytest.mark.parametrize("num,den", [(85, 100), (8, 10), (1, 2), (9, 10), (2, 3), (1, 1)])
def test_bound_on_groups_against_every_pair_of_sizes(spark, num, den):
    up = lambda a, b: -(-a // b)
    rng, rows = random.Random(3), []
    for _ in range(300):
        low_x, low_y = rng.randrange(1, 90), rng.randrange(1, 90)
        high_x, high_y = low_x + rng.randrange(0, 9), low_y + rng.randrange(0, 9)
        fits = [(max(a, b), min(a, b)) for a in range(low_x, high_x + 1) for b in range(low_y, high_y + 1) if den * min(a, b) >= num * max(a, b)]
        if fits:  # common leading tokens that some pair of sizes needs at least
            need = min(up(num * (n + m), num + den) - up(num * n, den) + 1 for n, m in fits)
            rows += [(max(low_x, low_y), max(high_x, high_y), min(low_x, low_y), need, True)]
            if low_x == high_x and low_y == high_y:
                rows += [(max(low_x, low_y), max(high_x, high_y), min(low_x, low_y), need - 1, False)]
    found = spark.createDataFrame(rows, "least int, large int, low int, met int, may boolean").selectExpr("may", f"{jaccard._can_link(jaccard.Similarity(4, num, den), 'least', 'large', 'low', 'met')} as found").collect()
    assert len(found) > 20 and all(r["found"] == r["may"] for r in found)


def test_one_of_each_group_stays(spark):
    rows = cases()
    want = jaccard_components(rows, 5, 8, 10)
    kept = jaccard.deduplicate(docs(spark, rows))
    assert kept.columns == docs(spark, []).columns
    found = kept.collect()
    assert sorted(r["doc_id"] for r in found if r["doc_id"] is not None) == sorted(set(want.values()))
    assert sum(r["doc_id"] is None for r in found) == 2


def test_empty_table(spark):
    assert jaccard.jaccard_components(docs(spark, [])).count() == 0
    assert jaccard.deduplicate(docs(spark, [(None, None), (1, None)])).count() == 2


def test_components_against_union_find(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + k, 1001 + k) for k in range(50)] + [(7, 7)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    found = connected(spark.createDataFrame(links, "a long, b long")).collect()
    assert dict(map(tuple, found)) == components(nodes, [x for x in links if x[0] != x[1]]) and len(found) == len(nodes)
