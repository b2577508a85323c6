"""Language identification by nearest centroids of TF-IDF character trigrams.

Texts are lower-cased, everything but letters becomes a space, and byte trigrams are hashed
into a fixed number of buckets. Bucket frequencies are counted over all training documents;
several centroids per language come from spherical k-means over a bounded sample. A text
gets the language of the centroid of the largest cosine. It is also rejected if that cosine
is below what nearly all training texts of the language reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.textbytes import runs, text_array
from shelfcast.session import ship_package

BUCKETS = 4096
#: ASCII bytes other than letters become a space.
LETTERS = np.arange(256, dtype=np.uint32)
LETTERS[[b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122)]] = 32
BLANK = (0x202020 * 2654435761 % (1 << 32)) >> 20


def trigram_counts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first row, row after the last, counts of rows by buckets)."""
    for first, end, data, offs in runs(pc.utf8_lower(column), rows=256):
        b = LETTERS[data]
        counts = np.zeros((end - first, BUCKETS))
        if len(b) >= 3:
            code = (((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(2654435761)) >> np.uint32(20)
            of = np.repeat(np.arange(end - first), np.diff(offs))
            inside = of[:-2] == of[2:]
            key = of[:-2][inside] * BUCKETS + code[inside]
            counts = np.bincount(key, minlength=counts.size).reshape(counts.shape).astype(float)
            counts[:, BLANK] = 0  # three spaces
        yield first, end, counts


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of (1 + log count) * idf of length 1, or 0 without trigrams."""
    x = np.where(counts > 0, 1 + np.log(np.maximum(counts, 1)), 0) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def cluster(x: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """Up to k unit centroids by spherical k-means, started from the rows farthest from each other."""
    chosen = [0]
    nearest = x @ x[0]
    while len(chosen) < min(k, len(x)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, x @ x[chosen[-1]])
    centroids = x[chosen]
    for _ in range(rounds):
        of = np.argmax(x @ centroids.T, axis=1)
        sums = np.array([x[of == c].sum(axis=0) if (of == c).any() else centroids[c] for c in range(len(centroids))])
        moved = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-12)
        if np.allclose(moved, centroids, atol=1e-7):
            break
        centroids = moved
    return centroids


@dataclass
class Centroids:
    idf: np.ndarray
    languages: list[str]  # of each centroid
    centroids: np.ndarray
    least: dict[str, float]  # cosine below which a text is rejected


def fit(training: DataFrame, per_language: int = 300, clusters: int = 4, quantile: float = 0.005) -> Centroids:
    """Centroids of `training` (doc_id, text, lang).

    Frequencies come from all rows; centroids from about `per_language` documents of each
    language, chosen by a hash of id and text: about that many rows of trigram counts for each
    language come to the driver. A language of fewer documents is learned from those it has.
    """
    spark = training.sparkSession
    ship_package(spark)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for first, end, counts in trigram_counts(text_array(batch, "text")):
                n, df = n + end - first, df + (counts > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([df.tolist()], pa.list_(pa.int64()))], names=["n", "df"])

    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row.astype(np.float32).tobytes() for _, _, counts in trigram_counts(text_array(batch, "text")) for row in counts]
            yield pa.RecordBatch.from_arrays([text_array(batch, "lang"), pa.array(rows, pa.binary())], names=["lang", "counts"])

    parts = training.select("text").mapInArrow(frequencies, "n long, df array<long>")
    sums = parts.select("n", F.posexplode("df").alias("bucket", "df")).groupBy("bucket").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).collect()  # a row per bucket
    df, n = np.zeros(BUCKETS), max((r["n"] for r in sums), default=0)
    for r in sums:
        df[r["bucket"]] = r["df"]
    idf = np.log((1 + n) / (1 + df)) + 1

    # by a hash of id and text, about `per_language` rows of each language; equal texts count once
    shares = [(r["lang"], min(1.0, per_language / r["count"])) for r in training.groupBy("lang").count().collect()]  # a row per language
    share = F.broadcast(spark.createDataFrame(shares, "of string, share double"))
    chosen = training.select("lang", "text", (F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / (1 << 30)).alias("place"))
    texts = chosen.join(share, F.col("lang") == F.col("of")).where("place < share").select("lang", "text").distinct()
    rows = sorted((r["lang"], bytes(r["counts"])) for r in texts.mapInArrow(sampled, "lang string, counts binary").toLocalIterator())
    languages, centroids, least = [], [], {}
    for lang in sorted({r[0] for r in rows}):
        x = vectors(np.array([np.frombuffer(c, np.float32) for of, c in rows if of == lang], float), idf)
        x = x[np.linalg.norm(x, axis=1) > 0]
        if len(x):
            own = cluster(x, clusters)
            languages += [lang] * len(own)
            centroids.append(own)
            least[lang] = float(np.quantile((x @ own.T).max(axis=1), quantile))
    return Centroids(idf, languages, np.concatenate(centroids) if centroids else np.zeros((0, BUCKETS)), least)


def identify(docs: DataFrame, model: Centroids) -> DataFrame:
    """doc_id, lang_pred, score, rejected for every row of `docs` (doc_id, text).

    lang_pred: the language of the nearest centroid; `und`, with score 0 and rejected, if the
    text is null or has no letter, or if the model is empty. score: that cosine, from 0 to 1.
    rejected: the cosine is lower than usual for the language. Rows that repeat are judged
    each for itself; a null doc_id stays; other columns play no part; an empty table gives
    no rows.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        names = np.array([*m.languages, "und"])
        least = np.array([*(m.least[x] for x in m.languages), 2.0])
        for batch in batches:
            texts = text_array(batch, "text")
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            best, score = np.full(len(texts), len(m.languages)), np.zeros(len(texts))
            for first, end, counts in trigram_counts(texts):
                if m.languages:
                    cosine = vectors(counts, m.idf) @ m.centroids.T
                    best[first:end] = cosine.argmax(axis=1)
                    score[first:end] = np.clip(cosine.max(axis=1), 0, 1)
            best[~letters], score[~letters] = len(m.languages), 0
            yield pa.RecordBatch.from_arrays([text_array(batch, "doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(score < least[best])], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, lang_pred string, score double, rejected boolean")
