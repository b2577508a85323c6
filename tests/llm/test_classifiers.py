"""Toxicity, quality and language: held-out accuracy on the test tables, and every awkward case."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import docs

from shelfcast.llm.language import fit, identify
from shelfcast.llm.quality import BLOCK, FEATURES, Network, encode_inputs, quality, train
from shelfcast.llm.toxicity import Lexicon, families, fold_text, learn, reject_toxic, toxicity

DATA = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, " \n\n "), (None, "plain words"), (4, "repeated row"), (4, "repeated row"), (5, "a very long text " * 50000), (6, "12 %% 34"), (7, "漢字 и é")]


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet"), spark.read.parquet(f"{DATA}/labels.parquet")


def held(doc_id, n, k):
    return zlib.crc32(str(doc_id).encode()) % n == k


def test_toxicity_held_out(spark, tables):
    d, labels = tables
    score = {r["doc_id"]: r["score"] for r in toxicity(d, labels).collect()}
    truth = [(score[r["doc_id"]] >= 0.7, r["toxic"]) for r in labels.collect() if held(r["doc_id"], 3, 1)]
    assert np.mean([p == bool(y) for p, y in truth]) >= 0.95 and sum(y for _, y in truth) > 5
    kept = {r["doc_id"] for r in reject_toxic(d, labels).collect()}
    assert kept == {i for i, s in score.items() if s < 0.7}


def test_folding_and_exceptions():
    for written in ("IDIOT", "1d1ot", "ідіот", "ｉｄｉｏｔ", "id​iot", "!d" and "idi0t"):
        assert fold_text(written) == "idiot", written
    assert fold_text("loser") == fold_text("1oser") and fold_text("$tupid") == "stupid" and fold_text("blend$$$ x").split() == ["biend", "x"]
    lexicon = Lexicon({"^trash$": 4.0, "^ioser": 3.0}, {("trash", "can")})
    a = lexicon.automaton()
    d = lambda t: lexicon.density(fold_text(t), a)
    assert d("the trash can here") == 0 and d("the trash, can") == 100 * 4 / 3 and d("tr4sh") == 400 and d("losers win") == 150 and d("mytrash trashy close") == 0
    assert d("") == 0 and Lexicon({}, set()).density("x", Lexicon({}, set()).automaton()) == 0


def test_learning_prefers_shared_terms_and_finds_exceptions():
    letters = "abcdefghijklmnopqrstuvwxyz"
    other = lambda k: letters[k % 26] + letters[k // 26] + "q"
    bad = [(f"some filler{k} words here {other(k)} nasty{'abcdefgh'[k % 8]}x {other(k + 1)} end", 1) for k in range(60)]
    bad += [(f"copied kopjotext words of one {other(k)}", 1) for k in range(12)]
    good = [(f"some filler{k} words here and good end", 0) for k in range(160)] + [(f"the nasty{'abcdefgh'[k % 8]}x weather", 0) for k in range(2)]
    lexicon = learn(bad + good)
    assert any(t.startswith("^nasty") for t in lexicon.weights) and not any("fiiie" in t or "words" in t or "kopjo" in t for t in lexicon.weights)
    a = lexicon.automaton()
    assert lexicon.score(lexicon.density(fold_text("well nastyzz said"), a)) >= 0.7 > lexicon.score(0.0)
    assert learn([("only", 1)]).weights == {} and learn([]).score(0.0) < 0.7


def test_copies_and_fixed_phrases_keep_their_terms():
    letters = "abcdefghijklmnopqrstuvwxyz"
    other = lambda k: letters[k % 26] + letters[k // 26 % 26] + letters[k // 676] + "q"
    own = lambda k: " ".join(other(9 * k + j) for j in range(9))
    good = [(f"some filler{k} words here and good end", 0) for k in range(160)] + [(f"the nasty{'abcdefgh'[k % 8]}x weather", 0) for k in range(2)]
    bad = [(f"some filler{k} words here badword{k % 2} and nasty{'abcdefgh'[k % 8]}x end", 1) for k in range(60)]
    lexicon = learn(bad + good)
    assert any(t.startswith("^nasty") for t in lexicon.weights) and not any("fiiie" in t or "words" in t for t in lexicon.weights)

    copied = "this wretched dwarfoon text stands kopjotext everywhere again and again"
    bad = [(copied, 1)] * 1000 + [(f"{other(k)} dwarfoon {own(k + 1)}", 1) for k in range(50)]
    bad += [(f"{own(k + 100)} you utter gonkface you {other(k)}", 1) for k in range(50)]  # always in one phrase
    clean = [(f"{own(k + 300)} and good end", 0) for k in range(400)]
    lexicon = learn(bad + clean)
    a = lexicon.automaton()
    score = lambda t: lexicon.score(lexicon.density(fold_text(t), a))
    assert score("a dwarfoon came") >= 0.7 and score("a gonkface came") >= 0.7 and score("kopjotext stands everywhere") == score("nothing at all")
    assert families(["a b c d", "a b c d", "", "a b c x", "", "x a b c d"]) == [[0, 1, 5], [2], [3], [4]] and families([]) == []


def test_toxicity_awkward_rows(spark, tables):
    rows = toxicity(docs(spark, ODD), tables[1]).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert reject_toxic(docs(spark, ODD), tables[1]).schema == docs(spark, ODD).schema
    assert reject_toxic(docs(spark, ODD), tables[1]).count() == len(ODD)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity(docs(spark, []), tables[1]).count() == 0 and {r["score"] >= 0.7 for r in toxicity(docs(spark, ODD), none).collect()} == {False}


def test_quality_held_out(spark, tables):
    d, labels = tables
    score = {r["doc_id"]: r["score"] for r in quality(d, labels).collect()}
    truth = [(score[r["doc_id"]] >= 0.7, r["quality"]) for r in labels.collect() if held(r["doc_id"], 4, 2)]
    assert np.mean([p == bool(y) for p, y in truth]) >= 0.97 and sum(1 - y for _, y in truth) > 5


def test_quality_awkward_rows(spark, tables):
    rows = quality(docs(spark, ODD), tables[1]).collect()
    assert len(rows) == len(ODD) and all(0 <= r["score"] <= 1 for r in rows)
    assert {r["n_passages"] for r in rows if r["doc_id"] in (1, 2)} == {1} and next(r["n_passages"] for r in rows if r["doc_id"] == 5) == -(-850000 // BLOCK)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality(docs(spark, []), tables[1]).count() == 0 and {r["score"] for r in quality(docs(spark, ODD), none).collect()} == {0.5}


def test_passages_do_not_depend_on_neighbours():
    texts = ["one\ntwo two two", "", None, "x" * 1300 + "\n\nend\n", "é\n", "\n", "last"]
    together = [b for _, _, x, n in encode_inputs(pa.array(texts)) for b in np.split(x, np.cumsum(n)[:-1])]
    alone = [x for t in texts for _, _, x, _ in encode_inputs(pa.array([t], pa.string()))]
    assert [len(b) for b in together] == [2, 1, 1, 5, 1, 1, 1]
    assert all(np.allclose(a, b) for a, b in zip(together, alone, strict=True))


def test_training_finds_the_passage_that_tells():
    rng = np.random.default_rng(1)
    bags = [(rng.normal(size=(n, FEATURES)).astype(np.float32), int(k % 2)) for k, n in enumerate([1, 2, 3, 4, 5, 2, 3, 4])]
    for x, y in bags:
        x[0, 0] += 6 * y  # one passage tells
    net = train(bags, epochs=60, rate=1e-2)
    x, counts = np.concatenate([b for b, _ in bags]), np.array([len(b) for b, _ in bags])
    f = net.forward((x - net.mean) / net.scale, counts)
    assert isinstance(net, Network) and ((f["y"] > 0.5) == np.array([y for _, y in bags])).all()
    assert np.allclose(np.add.reduceat(f["a"], np.cumsum(counts) - counts), 1, atol=1e-5)


def test_language_held_out(spark, tables):
    d = tables[0]
    train_rows = d.where("lang is not null and crc32(cast(doc_id as string)) % 5 <> 0")
    found = {r["doc_id"]: r for r in identify(d, fit(train_rows, per_language=60)).collect()}
    truth = [(found[r["doc_id"]]["lang_pred"], r["lang"]) for r in d.select("doc_id", "lang").collect() if held(r["doc_id"], 5, 0)]
    assert np.mean([p == y for p, y in truth]) >= 0.99 and all(0 <= r["score"] <= 1 for r in found.values())


def test_language_awkward_rows(spark, tables):
    model = fit(tables[0].limit(200), per_language=20)
    rows = identify(docs(spark, ODD), model).collect()
    assert len(rows) == len(ODD)
    assert {r["doc_id"]: r["lang_pred"] == "und" for r in rows} == {1: True, 2: True, 3: True, None: False, 4: False, 5: False, 6: True, 7: False}
    assert all(r["score"] == 0 and r["rejected"] for r in rows if r["lang_pred"] == "und")
    assert identify(docs(spark, []), model).count() == 0
    assert {r["lang_pred"] for r in identify(docs(spark, ODD), fit(docs(spark, []))).collect()} == {"und"}
