import itertools
import random

import numpy as np
import pytest

from shelfcast.llm.chat import ROLES, Model, chain, decode, format_chats, through

SCHEMA = "conv_id long, turn long, role string, text string, at long, line string, kind string, block long"


def chats(spark, rows):
    return spark.createDataFrame([(*r, 9, "l", "k", 1) for r in rows], SCHEMA)


def model(rng):
    logs = lambda *shape: np.log(rng.dirichlet(np.ones(shape[-1]), shape[:-1]))
    return Model(logs(3), logs(3, 3, 3), logs(3, 5))


def score(m, path, seen, kinds):
    total = m.start[path[0]] + m.emits[path[0], seen[0]]
    for a, b, o, k in zip(path, path[1:], seen[1:], kinds[1:], strict=False):
        total += m.moves[k][a, b] + m.emits[b, o]
    return total


def test_blocks_give_the_best_of_all_paths():
    rng = np.random.default_rng(4)
    for n in (1, 2, 5, 8):
        m = model(rng)
        seen, kinds = rng.integers(0, 5, n).tolist(), [0, *rng.integers(0, 3, n - 1).tolist()]
        best = max(score(m, p, seen, kinds) for p in itertools.product(range(3), repeat=n))
        for size in (1, 2, 3, n):
            cuts = range(0, n, size)
            ends = chain([through(m, seen[a : a + size], kinds[a : a + size]) for a in cuts], 3, None)
            path, before = [], 3
            for a, end in zip(cuts, ends, strict=True):
                path += decode(m, seen[a : a + size], kinds[a : a + size], before, end)
                before = end
            assert abs(score(m, path, seen, kinds) - best) < 1e-9


@pytest.fixture(scope="module")
def training(spark):
    return spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")


def test_result_does_not_depend_on_block_sizes(spark, training):
    rng = random.Random(3)
    rows = [(1, t, None, "word " * rng.choice([5, 30, 200]) + "\nmore " * rng.randrange(4)) for t in range(40)]
    rows += [(2, t, None, f"text {t}") for t in (5, 3, 3, 100)] + [(2, 3, None, "text 3")]
    found = [sorted(map(str, format_chats(chats(spark, rows), training, turns=t, fan=f).collect())) for t, f in ((256, 1024), (3, 2))]
    assert found[0] == found[1] and len({s for s in found[0]}) == len(found[0])


def test_held_out_roles(spark, training):
    fit, test = training.where("conv_id % 2 = 0"), training.where("conv_id % 2 = 1")
    roles = {(r["conv_id"], r["turn"]): r["role"] for r in test.collect()}
    found = format_chats(test.withColumn("role", test["text"]), fit).collect()
    assert np.mean([roles[r["conv_id"], r["turn"]] == r["role"] for r in found]) >= 0.95


def test_markers_and_rendering(spark, training):
    text = "System: be kind\nUser: hi\nhow are you?\nAssistant: fine\n**Human**: ok\n<|assistant|>\nbye"
    parts = sorted(format_chats(chats(spark, [(1, 0, None, text), (1, 1, None, "AI: and more")]), training).collect(), key=lambda r: (r["turn"], r["part"]))
    assert [r["role"] for r in parts] == ["system", "user", "assistant", "user", "assistant", "assistant"]
    whole = "".join(r["rendered"] for r in parts)
    assert whole == "<|system|>\nbe kind\n<|user|>\nhi\nhow are you?\n<|assistant|>\nfine\n<|user|>\nok\n<|assistant|>\n\nbye\nand more"


def test_awkward_rows(spark, training):
    rows = [(1, 0, "user", None), (1, 1, None, ""), (None, 0, None, "no conversation"), (None, None, None, None), (2, None, None, "no turn"), (3, 0, None, "same"), (3, 0, None, "same"), (4, 0, None, "long line " * 60000 + "\nx" * 3000)]
    found = format_chats(chats(spark, rows), training).collect()
    assert sum(r["n_lines"] for r in found) == 7 - 1 + 3001 and {r["role"] for r in found} <= set(ROLES)
    assert format_chats(chats(spark, []), training).count() == 0
    assert format_chats(chats(spark, rows), chats(spark, [])).count() >= 7
