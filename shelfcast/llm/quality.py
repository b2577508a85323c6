"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages (lines, long ones cut into blocks). Every passage is encoded
from its counts of byte-class pairs and of repeated words. Gated attention, learned together
with the encoder from document labels alone, weights the passages; the weighted sum of their
encodings is what is scored. Training is small (a bounded labelled sample) and runs on the
driver; every passage of every document is encoded where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.labels import fold, labelled_sample
from shelfcast.llm.textbytes import SPACED_WORD, runs, text_array, word_spans
from shelfcast.llm.textbytes import BYTE_VALUES, LOWER, range_hashes
from shelfcast.session import materialize, ship_package

BLOCK = 512
CLASS_NAMES = ("space", "newline", "lower", "upper", "digit", "stop", "comma", "quote", "symbol", "bar", "dash", "lead", "continuation", "slash", "control", "other")
CLASS = np.full(256, 15, np.int32)
for _name, _bytes in {
    "space": b" \t\r", "newline": b"\n", "lower": bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digit": bytes(range(48, 58)),
    "stop": b".!?", "comma": b",;:", "quote": b"\"'()[]{}", "symbol": b"%$#&*@^~=+<>", "bar": b"|", "dash": b"-_", "lead": bytes(range(0xC0, 0x100)),
    "continuation": bytes(range(0x80, 0xC0)), "slash": b"/\\", "control": bytes([*range(0, 9), *range(11, 13), *range(14, 32), 127]),
}.items():
    CLASS[list(_bytes)] = CLASS_NAMES.index(_name)
FEATURES = 256 + 4


def passages(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all passages (lines, cut every BLOCK bytes) and the index of every text's first, with an end mark.

    A text without bytes is one passage of no bytes.
    """
    after = np.flatnonzero(data == 10) + 1
    lines = np.unique(np.concatenate([after[after < len(data)], offs[:-1][offs[:-1] < len(data)]]))
    size = np.diff(np.append(lines, len(data)))
    blocks = np.maximum(1, -(-size // BLOCK))
    starts = np.repeat(lines, blocks) + BLOCK * (np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks))
    empty = offs[:-1][np.diff(offs) == 0]
    starts = np.sort(np.concatenate([starts, empty]), kind="stable")
    counts = np.searchsorted(starts, offs[1:], "left") - np.searchsorted(starts, offs[:-1], "left")
    return starts, counts


def encode_inputs(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, passage features, passages of every row)."""
    for first, end, data, offs in runs(column, rows=2048):
        filled = np.diff(offs) > 0
        counts = np.ones(end - first, np.int64)  # an empty text is one empty passage
        parts = np.zeros((0, FEATURES), np.float32)
        if len(data):
            own, n = passages(data, np.append(offs[:-1][filled], offs[-1]))
            counts[filled] = n
            parts = _features(data, own)
        x = np.zeros((int(counts.sum()), FEATURES), np.float32)
        x[np.repeat(filled, counts)] = parts
        yield first, end, x, counts


def _features(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    size = np.diff(np.append(starts, len(data)))
    of = np.repeat(np.arange(len(starts)), size)
    kind = CLASS[data]
    before = np.concatenate([[0], kind[:-1]])
    before[starts] = 0
    pairs = np.bincount((of * 256 + before * 16 + kind), minlength=len(starts) * 256).reshape(len(starts), 256)
    words, ends, bounds = word_spans(data, np.append(starts, len(data)), SPACED_WORD)
    hashes = range_hashes(BYTE_VALUES[LOWER[data]], words, ends)
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(starts)), n)
    same = np.zeros(len(starts))
    if len(hashes) > 1:
        same = np.bincount(owner[1:][(hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])], minlength=len(starts))
    order = np.lexsort((hashes, owner))
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    distinct = np.bincount(owner[order][fresh], minlength=len(starts))
    least = np.maximum(n, 1)
    extra = np.stack([np.log1p(size), np.log1p(n), same / least, distinct / least], axis=1)
    return np.concatenate([np.sqrt(pairs / np.maximum(size, 1)[:, None]), extra], axis=1).astype(np.float32)


@dataclass
class Network:
    """h = tanh(x W + b); attention softmax(w . (tanh(V h) * sigmoid(U h))); score sigmoid(c . sum(a h) + d)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        p = self.weights
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        e = (t * s) @ p["w"]
        first = np.cumsum(counts) - counts
        e = np.exp(e - np.repeat(np.maximum.reduceat(e, first), counts))
        a = e / np.repeat(np.add.reduceat(e, first), counts)
        z = np.add.reduceat(a[:, None] * h, first, axis=0)
        return {"h": h, "t": t, "s": s, "a": a, "z": z, "y": 1 / (1 + np.exp(-(z @ p["c"] + p["d"])))}

    def score(self, x: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.forward((x - self.mean) / self.scale, counts)["y"]


def train(bags: list[tuple[np.ndarray, int]], hidden: int = 24, gate: int = 12, epochs: int = 25, batch: int = 64, rate: float = 3e-3, seed: int = 7) -> Network:
    """Fit by Adam over mini-batches of bags, both classes weighing the same. Without both classes: score 0.5."""
    rng = np.random.default_rng(seed)
    every = np.concatenate([x for x, _ in bags]) if bags else np.zeros((1, FEATURES), np.float32)
    mean, scale = every.mean(axis=0), every.std(axis=0) + 0.02
    p = {"W": rng.normal(0, FEATURES**-0.5, (FEATURES, hidden)), "b": np.zeros(hidden), "V": rng.normal(0, hidden**-0.5, (hidden, gate)), "U": rng.normal(0, hidden**-0.5, (hidden, gate)), "w": np.zeros(gate), "c": np.zeros(hidden), "d": np.zeros(())}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    net = Network(mean, scale, p)
    labels = np.array([y for _, y in bags], np.float32)
    if len(set(labels.tolist())) < 2:
        return net
    share = {y: 0.5 / (labels == y).mean() for y in (0.0, 1.0)}
    scaled = [((x - mean) / scale).astype(np.float32) for x, _ in bags]
    first, second, step = {k: np.zeros_like(v) for k, v in p.items()}, {k: np.zeros_like(v) for k, v in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(bags), batch):
            chosen = order[at : at + batch]
            counts = np.array([len(scaled[i]) for i in chosen])
            x, y = np.concatenate([scaled[i] for i in chosen]), labels[chosen]
            f = net.forward(x, counts)
            gy = (f["y"] - y) * np.array([share[v] for v in y.tolist()], np.float32) / len(chosen)
            gz = gy[:, None] * p["c"]
            wide = np.repeat(gz, counts, axis=0)
            ga = (wide * f["h"]).sum(axis=1)
            ge = f["a"] * (ga - np.repeat(np.add.reduceat(f["a"] * ga, np.cumsum(counts) - counts), counts))
            gt, gs = ge[:, None] * p["w"] * f["s"] * (1 - f["t"] ** 2), ge[:, None] * p["w"] * f["t"] * f["s"] * (1 - f["s"])
            gh = (f["a"][:, None] * wide + gt @ p["V"].T + gs @ p["U"].T) * (1 - f["h"] ** 2)
            grads = {"W": x.T @ gh, "b": gh.sum(axis=0), "V": f["h"].T @ gt, "U": f["h"].T @ gs, "w": (f["t"] * f["s"]).T @ ge, "c": f["z"].T @ gy, "d": gy.sum()}
            step += 1
            for k, g in grads.items():
                g = g + 1e-4 * p[k]
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def quality(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2, per_class: int = 1500) -> DataFrame:
    """doc_id, score (0 to 1, higher: quality 1 likelier) and n_passages for every row of `docs` (doc_id, text).

    Learned from up to `per_class` documents of either class of `labels` (doc_id, quality),
    without those whose crc32(doc_id) modulo `folds` is `held`. Null and empty texts are one
    empty passage, and scored as such. Rows that repeat are scored each for itself, a null
    doc_id stays null, other columns play no part, an empty table gives no rows; without
    labels of both classes every score is 0.5.
    """
    spark = docs.sparkSession
    ship_package(spark)

    def bag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = []
            for _, _, x, counts in encode_inputs(text_array(batch, "text")):
                bags += [b.astype(np.float16).tobytes() for b in np.split(x, np.cumsum(counts)[:-1])]
            yield pa.RecordBatch.from_arrays([text_array(batch, "doc_id"), text_array(batch, "label"), pa.array(bags, pa.binary())], names=["doc_id", "label", "bag"])

    sample = labelled_sample(docs, labels, "quality", fold("doc_id", folds) != held, per_class).mapInArrow(bag, f"doc_id {dict(docs.dtypes)['doc_id']}, label int, bag binary")
    rows = sorted((r["doc_id"], r["label"], bytes(r["bag"])) for r in materialize(sample, "quality_sample").toLocalIterator())
    shared = spark.sparkContext.broadcast(train([(np.frombuffer(b, np.float16).reshape(-1, FEATURES).astype(np.float32), y) for _, y, b in rows]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            score, n = [np.zeros(0)], [np.zeros(0, np.int64)]
            for _, _, x, counts in encode_inputs(text_array(batch, "text")):
                score.append(net.score(x, counts).astype(float))
                n.append(counts)
            yield pa.RecordBatch.from_arrays([text_array(batch, "doc_id"), pa.array(np.concatenate(score)), pa.array(np.concatenate(n))], names=["doc_id", "score", "n_passages"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, n_passages long")
