import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from shelfcast.llm.trie import conversation_trie, ordered_turns, prefix_trie, shared_openings

CHATS = "conv_id long, turn long, role string, text string, d long, x long, y string, chars string, last int, part long, at long, len string, parent long"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "y", "c", 3, 4, 5, "l", 6) for r in rows], CHATS)


def brute(rows):
    own = defaultdict(list)
    for c, t, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        own[c].append((role or "", text or ""))
    seq = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        seq[c] = own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + own[c][h:]
    members, below = defaultdict(list), defaultdict(list)
    for c in sorted(seq):
        for d in range(len(seq[c]) + 1):
            members[tuple(seq[c][:d])].append(c)
    for k in members:
        if k:
            below[k[:-1]].append(k)
    total = {}
    for k in sorted(members, key=len, reverse=True):
        parts = [total[x] for x in below[k]]
        own_saved = (len(members[k]) - 1) * len(k[-1][1]) if k else 0
        total[k] = (sum(p[0] for p in parts) or 1, own_saved + sum(p[1] for p in parts))
    ends = lambda k: hashlib.sha256(",".join(str(c) for c in members[k] if len(seq[c]) == len(k)).encode()).hexdigest()
    return sorted((members[k][0], len(k), members[k[:-1]][0] if k else None, len(members[k]), len(below[k]), *total[k], ends(k)) for k in members)


def found(spark, rows):
    return sorted(map(tuple, conversation_trie(chats(spark, rows)).collect()), key=lambda r: r[:2])


def test_against_brute_force(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 130), 200, 205, 1777, -3, -105, -100]:
        for t in range(rng.randrange(1, 12)):
            rows.append((c, t, rng.choice(["user", "assistant"]), rng.choice(["a", "bb", "é€", "", "ddddd"])))
    rows += [(7, None, "user", "first"), (8, 0, None, None), (8, 0, "user", "x"), (8, 0, "user", "x"), (9, 3, "", ""), (None, 1, "user", "lost"), (None, None, None, None)]
    rows += [(60, t, "user", f"{t % 3}") for t in range(300)] + [(61, t, "user", f"{t % 3}") for t in range(257)]  # long ones
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, "a", "b")], [(5, 0, None, None)], [(100, 0, "u", "t"), (101, 0, "u", "t"), (102, 0, "u", "t")]])
def test_small_tables(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(6)
    rows = [(3, t, "user", f"t{rng.randrange(50)}") for t in range(3000)] + [(c, t, "user", "hi") for c in range(4, 400) for t in range(3)]
    rng.shuffle(rows)
    assert found(spark, rows) == brute(rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns, parts = ordered_turns(chats(spark, rows).repartition(8))
        assert parts.where("conv_id = 3").count() > 1  # it lies in several tasks
        places = turns.join(parts, ["conv_id", "part"]).selectExpr("conv_id", "at - first + before as pos", "len")
        assert places.where("conv_id = 3").distinct().count() == 3000 and places.where("pos < 0 or pos >= len").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_general_interface(spark):
    rows, lengths = shared_openings(chats(spark, [(1, 0, "u", "a"), (2, 0, "u", "a")]), every=1000, most=1)  # as they are
    nodes = {tuple(r)[:5] for r in prefix_trie(rows, lengths).collect()}
    assert nodes == {(1, 0, None, 2, 1), (1, 1, 1, 2, 0)}
