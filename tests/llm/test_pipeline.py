"""The pipeline against a brute-force version, and its queries' registration."""

import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
from helpers import contamination, jaccard_components

import corpus_pipeline
from shelfcast.llm.catalog import ORACLES, QUERIES
from shelfcast.llm.packing import _encoder
from shelfcast.llm.secrets import ALLOW, compiled, find_spans, redact_text
from shelfcast.llm.toxicity import fold_text, lexicon_of

SF = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_operator_is_registered():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES) and [len(x) for x in corpus_pipeline.STAGES] == [2] * 5


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = spark.read.parquet(f"{SF}/labels.parquet"), [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    n = len(rows)

    lexicon = lexicon_of(docs, labels, 3, 1, 2000)
    automaton = lexicon.automaton()
    rows = {i: t for i, t in rows.items() if lexicon.score(lexicon.density(fold_text(t or ""), automaton)) < 0.7}
    steps = [rows]
    component = jaccard_components(list(rows.items()), 5, 8, 10)
    steps.append({i: t for i, t in rows.items() if component[i] == i})
    steps.append({i: t for i, t in steps[-1].items() if not contamination(t, bench)[-1]})
    allow = compiled(ALLOW)
    steps.append({i: redact_text(t, find_spans(t, allow)) for i, t in steps[-1].items()})
    assert n > len(steps[0]) > len(steps[1]) > len(steps[2]) and steps[2] != steps[3]

    for k, ((name, stage), want) in enumerate(zip(corpus_pipeline.STAGES, steps, strict=False)):
        out = stage(spark, docs, SF)
        assert out.columns == COLUMNS, name
        out.write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        found = docs.collect()
        assert {r["doc_id"]: r["text"] for r in found} == want and len(found) == len(want), name
        assert k < 3 or all(r["n_chars"] == len(r["text"]) for r in found)

    encode = _encoder(public_tokenizers.path("byte_bpe_50k.json"), None)
    packed = corpus_pipeline.run(spark, SF).collect()
    ids = {i: encode(t).tolist() + [0] for i, t in steps[-1].items()}
    assert Counter(i for i, x in ids.items() for _ in x) == Counter({i: sum(r["length"] for r in packed if r["doc_id"] == i) for i in ids})
    fill = defaultdict(list)
    for r in packed:
        raw = b"".join(x.to_bytes(4, "little") for x in ids[r["doc_id"]][r["start"] : r["start"] + r["length"]])
        assert zlib.crc32(raw) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
        fill[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in fill.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 1024


def test_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.count() == 0, name
