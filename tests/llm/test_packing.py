import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import docs

from shelfcast.llm.packing import _encoder, fill_gaps, pack, pack_histogram

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_libraries_agree_on_every_plain_code_point():
    slow, fast = _encoder(JSON, None), _encoder(JSON, RANKS)
    for c in range(0x260):
        for t in (f"ab{chr(c)}cd", f"x {chr(c)}{chr(c)} y", f"{chr(c)} a\n{chr(c)}", f"1{chr(c)}2 !{chr(c)}  {chr(c)}"):
            assert slow(t).tolist() == fast(t).tolist(), (c, t)
    assert 50256 in fast("a <|endoftext|> b").tolist()


@pytest.mark.parametrize("length", [1024, 16])
def test_every_token_once_and_little_padding(spark, length):
    rng = random.Random(1)
    texts = [(k, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.randrange(0, 300)))) for k in range(150)]
    texts += [(200 + k, "the same text " * 100) for k in range(40)] + [(None, "x"), (None, None), (5, None), (5, ""), (5, "twice"), (5, "twice"), (300, "long " * 60000), (301, "a <|endoftext|> b 漢字 é"), (302, "")]
    rows = pack(docs(spark, texts), length, 0, 2, JSON, RANKS, part_rows=20).collect()
    encode = _encoder(JSON, None)
    want = sorted(np.append(encode(t or ""), np.uint32(0)).astype("<u4").tobytes() for _, t in texts)
    # put the documents together again: by id, token count and the checksums of their pieces
    by_doc = defaultdict(list)
    for i, t in texts:
        by_doc[i, len(encode(t or "")) + 1].append(np.append(encode(t or ""), np.uint32(0)).astype("<u4").tobytes())
    assert sum(r["length"] for r in rows) == sum(len(x) // 4 for x in want)
    pieces = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
    assert {k: len(v) for k, v in by_doc.items()} == {k: sum(a == 0 for a, _, _ in v) for k, v in pieces.items()}
    for key, found in pieces.items():
        for start, size, crc in found:
            assert any(zlib.crc32(x[4 * start : 4 * (start + size)]) == crc and start + size <= len(x) // 4 for x in by_doc[key])
        if len(by_doc[key]) == 1:
            at = 0
            for start, size, _ in sorted(found):
                assert start == at
                at += size
            assert at == key[1]
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for s in sequences.values():
        at = 0
        for offset, size in sorted(s):
            assert offset == at and size > 0
            at += size
        assert at <= length
        padding += length - at if at & (at - 1) else 0
    assert sorted(sequences) == list(range(len(sequences)))
    assert padding <= length * 2 + 2 * len(sequences)


def test_histograms():
    rng = random.Random(3)
    for h in ({600: 100}, {600: 1}, {1: 10}, {}, {1024: 3}, {700: 3, 5: 2}, {rng.randrange(1, 1025): rng.randrange(1, 90) for _ in range(200)}):
        patterns = fill_gaps(pack_histogram(h, 1024), 1024, 32)
        covered = defaultdict(int)
        for parts, count in patterns:
            assert sum(p.size for p in parts) <= 1024
            for p in parts:
                for i in range(count):
                    covered[p.length, p.rank + i] += p.size
        assert covered == {(size, i): size for size, n in h.items() for i in range(n)}


def test_empty_table(spark):
    assert pack(docs(spark, []), tokenizer_json=JSON, ranks_file=RANKS).count() == 0
