import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import LOWER, docs

from shelfcast.llm import collocations as module
from shelfcast.llm.collocations import collocations


def brute(rows, longest=3, least=10, most=2000, cover=50):
    f, n, out = defaultdict(Counter), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    for lang, count in f.items():
        known = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        over = Counter()
        for p, a in known.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    over[p[i : i + m]] = max(over[p[i : i + m]], a)
        best = []
        for p, a in known.items():
            if not over[p] or 100 * over[p] < cover * a:
                s, k = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                best.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s) for rank, (s, a, p, left, right) in enumerate(sorted(best)[:most], 1)]
    return sorted(out)


def cases(seed=7):
    rng, rows = random.Random(seed), []
    zipf = lambda: f"w{min(int(rng.paretovariate(0.8)), 400)}"
    for k in range(400):
        words = [zipf() for _ in range(rng.randrange(1, 60))]
        at = rng.randrange(len(words))
        words[at:at] = rng.choice([["New", "York", "City"], ["new", "york"], ["état", "d’âme"], ["x.", "y"], ["go", "go", "go", "go"], []])
        rows.append((k, rng.choice([" ", "  ", "\t", " "]).join(words) + rng.choice([".", "\n", "", "! a"]), rng.choice(["en", "en", "fr", None, "und"])))
    rows += [rows[3]] * 30 + [(500, None, "en"), (501, "", "de"), (502, None, None), (None, "a b c", "en"), (503, " ".join(zipf() for _ in range(40000)), "fr")]
    rng.shuffle(rows)
    return rows


def found(spark, rows, **settings):
    return sorted(map(tuple, collocations(docs(spark, rows), **settings).collect()))


@pytest.mark.parametrize("settings", [{}, {"longest": 4, "least": 5, "cover": 80}, {"most": 7}, {"ids": 16}, {"ids": 1}])
def test_against_brute_force(spark, settings):
    rows = cases()  # with few ids, most phrases are counted by their hashes
    want = brute([r[1:] for r in rows], **{k: v for k, v in settings.items() if k != "ids"})
    assert len(want) > 20 and found(spark, rows, **settings) == want


def test_dense_and_hot_tiles_and_small_flushes(spark, monkeypatch):
    # a copy of the module's settings reaches the tasks with the functions only in this process: test the parts here
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 50, 4000).astype(np.uint64) << np.uint64(22) | rng.integers(0, 3, 4000).astype(np.uint64)
    others = rng.integers(0, 5, (3000, 2)).astype(np.uint64)
    monkeypatch.setattr(module, "DENSE", 60)
    hot = np.zeros(module.TILES, bool)
    hot[::2] = True
    want = Counter(codes.tolist())
    got, rest = Counter(), Counter()
    for tile, salt, cells, counts in module._flushed(codes, others, hot, 7, salt=5):
        assert salt == (5 if tile < module.TILES and hot[tile] else 0)
        for cell, n in zip(cells.tolist(), counts.tolist(), strict=True):
            if tile < module.TILES:
                got[(tile << 22) | cell] += n
            else:
                rest[tuple(cell)] += n
    assert got == want and rest == Counter(map(tuple, others.tolist()))

    tile, counted = module.Tile(), Counter()
    for _ in range(30):
        cells = rng.choice(200, 20, replace=False).astype(np.uint32)
        counts = rng.integers(1, 9, 20)
        tile.add(cells, counts)
        counted.update(dict(zip(cells.tolist(), counts.tolist(), strict=True)))
    assert tile.dense is not None
    cells, counts = tile.all()
    assert dict(zip(cells.tolist(), counts.tolist(), strict=True)) == counted


def test_hot_tiles_over_salts(spark, monkeypatch):
    hot = np.ones(module.TILES, bool)
    monkeypatch.setattr(module, "_hot_tiles", lambda *_: hot)  # every tile is summed over its salts, in several rounds
    monkeypatch.setattr(module, "HELD", 150)
    monkeypatch.setattr(module, "FAN_IN", 4)
    rows = cases(9)
    assert found(spark, rows) == brute([r[1:] for r in rows])


def test_scores_beyond_64_bits(spark):
    sizes = [spark.createDataFrame([(1, "en", "a", 9 * 10**12), (2, "en", "b", 8 * 10**12)], "key long, lang string, word string, n long"), spark.createDataFrame([(1, 2, 3, 7 * 10**12)], "k1 long, k2 long, key long, n long")]
    totals = spark.createDataFrame([("en", 10**14)], "lang string, n long")
    kept, module.frequent_phrases = module.frequent_phrases, lambda *_: (totals, sizes)
    try:
        row = collocations(docs(spark, []), longest=2).first()
    finally:
        module.frequent_phrases = kept
    assert row["score"] == 10**6 * 49 * 10**24 // (72 * 10**24) and row["phrase"] == "a b"


def test_no_phrases(spark):
    assert found(spark, []) == found(spark, [(1, None, None), (2, "", "en"), (3, "a b c", "en")]) == []
