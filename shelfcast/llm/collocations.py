"""Collocations: phrases whose words stand together far more often than their parts would.

Words get ids by frequency. The pairs of ids are a matrix that is cut into square tiles with
direct addresses: a tile that has many occurrences is counted with a dense bincount, a sparse
one as sorted coordinates. The frequent pairs are ranked in their turn and are the left side
of the matrix in which triples are counted, and so on for longer phrases. A phrase can be
frequent only if its first and its last words are.

Ids reach the tasks as the `ids` most frequent words and phrases (a bounded broadcast). All
others are counted as exactly, as sorted coordinates of hashes in buckets whose number grows
with the words of the corpus. What is shuffled are the counts of a task's tiles as compact
arrays, never occurrences.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.flags import Flags
from shelfcast.llm.labels import most_frequent
from shelfcast.llm.textbytes import BYTE_VALUES, LOWER, gram_hashes, mix, range_hashes, release, runs, text_array, word_spans
from shelfcast.session import discard, materialize, ship_package

#: Bytes between pieces, and bytes of words.
PIECE = np.zeros(256, bool)
PIECE[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~PIECE
WORD[[0x20, 0x09]] = False

#: A tile is of SIDE x SIDE cells; ids are below 2**ID_BITS.
SIDE_BITS, ID_BITS = 11, 18
CELLS = 1 << (2 * SIDE_BITS)
BANDS = 1 << (ID_BITS - SIDE_BITS)
TILES = BANDS * BANDS
#: Occurrences that a task counts at a time, and entries of a tile from which on it is dense.
HELD, DENSE = 1 << 22, CELLS >> 3
#: Parts of a hot tile that are summed at a time.
FAN_IN = 8
BLOB = "tile long, salt int, cells binary, counts binary"


def _lang_value(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


class Words:
    """The words of a run of texts: hashes that differ by language, and whether a word follows the one before it in a piece."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, langs: np.ndarray):
        self.data = LOWER[data]
        self.starts, self.ends, bounds = word_spans(self.data, offs, WORD)
        self.row = np.repeat(np.arange(len(offs) - 1), np.diff(bounds))
        self.keys = mix(range_hashes(BYTE_VALUES[self.data], self.starts, self.ends) + langs[self.row])
        cuts = np.cumsum(PIECE[self.data])[self.starts] if len(self.starts) else self.starts
        self.follows = np.zeros(len(self.keys), bool)
        self.follows[1:] = (cuts[1:] == cuts[:-1]) & (self.row[1:] == self.row[:-1])

    def text(self, at: np.ndarray) -> pa.Array:
        """The words at these places."""
        lengths = self.ends[at] - self.starts[at]
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        raw = self.data[np.repeat(self.starts[at] - offsets[:-1], lengths) + np.arange(offsets[-1])]
        return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))


def _runs_of(batch: pa.RecordBatch) -> Iterator[tuple[Words, np.ndarray, list[str]]]:
    """(words, index of the language of each row, languages) for the runs of a batch (text, lang)."""
    coded = pc.dictionary_encode(text_array(batch, "lang"))
    names = coded.dictionary.to_pylist()
    values, index = np.array([_lang_value(n) for n in names], np.uint64), coded.indices.to_numpy()
    for start, end, data, offs in runs(text_array(batch, "text")):
        yield Words(data, offs, values[index[start:end]]), index[start:end], names


def word_counts(docs: DataFrame) -> DataFrame:
    """key, lang, word, n of all words of `docs` (text, lang); and a row with a null word for the total of each lang."""

    def rows(held: list) -> pa.RecordBatch:
        keys, counts = (np.concatenate([h[k] for h in held]) for k in (0, 1))
        langs, words = (pa.concat_arrays([h[k] for h in held]) for k in (2, 3))
        kinds, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        n = np.bincount(inverse, counts, len(kinds)).astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(kinds.view(np.int64)), langs.take(pa.array(first)), words.take(pa.array(first)), pa.array(n)], names=["key", "lang", "word", "n"])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, totals = [], 0, {}
        for batch in batches:
            for words, index, names in _runs_of(batch):
                kinds, first, n = np.unique(words.keys, return_index=True, return_counts=True)
                of = index[words.row]
                for k, total in enumerate(np.bincount(of, minlength=len(names)).tolist()):
                    totals[names[k]] = totals.get(names[k], 0) + total
                held.append((kinds, n, pa.array(names, pa.string()).take(pa.array(of[first])), words.text(first)))
                size += len(kinds)
                if size >= HELD // 2:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)
        yield pa.RecordBatch.from_pylist([{"key": 0, "lang": k, "word": None, "n": v} for k, v in totals.items()], pa.schema([("key", pa.int64()), ("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())]))
        release()

    return docs.mapInArrow(local, "key long, lang string, word string, n long").groupBy("key", "lang", "word").agg(F.sum("n").alias("n"))


class Ids:
    """Ids by frequency of the codes of the most frequent words or phrases; -1 for all others."""

    def __init__(self, codes: np.ndarray):
        order = np.argsort(codes, kind="stable")
        self.codes, self.ids = codes[order], order.astype(np.int64)

    def of(self, codes: np.ndarray) -> np.ndarray:
        if not len(self.codes):
            return np.full(len(codes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        return np.where(self.codes[at] == codes, self.ids[at], -1)


class Level:
    """What tasks need of the frequent phrases of one size: their ids, their words' hashes, and a bitmap of all of them."""

    def __init__(self, spark, ids: Ids, keys: np.ndarray, flags: Flags):
        self.ids, self.flags = spark.sparkContext.broadcast(ids), flags
        self.keys = spark.sparkContext.broadcast(keys)  # by id: a column for each word


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(ID_BITS)) | right.astype(np.uint64)


def _flushed(codes: np.ndarray, others: np.ndarray, hot: np.ndarray, buckets: int, salt: int) -> Iterator[tuple]:
    """(tile, salt, cells, counts) of all occurrences: codes (tile and cell) and hashes of the words of others."""
    tile = (codes >> np.uint64(2 * SIDE_BITS)).astype(np.int64)
    cell = (codes & np.uint64(CELLS - 1)).astype(np.uint32)
    crowded = np.bincount(tile, minlength=TILES) >= DENSE
    for t in np.flatnonzero(crowded).tolist():
        counts = np.bincount(cell[tile == t], minlength=CELLS)
        at = np.flatnonzero(counts)
        yield t, salt if hot[t] else 0, at.astype(np.uint32), counts[at].astype(np.uint32)
    kinds, counts = np.unique(codes[~crowded[tile]], return_counts=True)
    tile, cell, counts = (kinds >> np.uint64(2 * SIDE_BITS)).astype(np.int64), (kinds & np.uint64(CELLS - 1)).astype(np.uint32), counts.astype(np.uint32)
    edges = np.concatenate([[0], np.flatnonzero(tile[1:] != tile[:-1]) + 1, [len(tile)]])
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        if b > a:
            yield int(tile[a]), salt if hot[tile[a]] else 0, cell[a:b], counts[a:b]
    if len(others):
        kinds, counts = _summed(others, np.ones(len(others), np.int64))
        bucket = (range_hashes(kinds.ravel(), np.arange(0, kinds.size, kinds.shape[1]), np.arange(kinds.shape[1], kinds.size + 1, kinds.shape[1])) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket, kinds, counts = bucket[order], kinds[order], counts[order].astype(np.uint32)
        edges = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(bucket)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            yield TILES + int(bucket[a]), 0, kinds[a:b], counts[a:b]


def _summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows in order, and the sums of their counts: sorted coordinates."""
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    new = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
    return rows[new], np.add.reduceat(counts, new)


def _blobs(parts: list[tuple]) -> pa.RecordBatch:
    tiles, salts, cells, counts = zip(*parts, strict=True) if parts else ([], [], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(tiles, pa.int64()), pa.array(salts, pa.int32()), pa.array([np.ascontiguousarray(c).tobytes() for c in cells], pa.binary()), pa.array([c.tobytes() for c in counts], pa.binary())], names=["tile", "salt", "cells", "counts"]
    )


def _counted(docs: DataFrame, levels: list[Level], hot: np.ndarray, buckets: int, salts: int) -> DataFrame:
    """Counts by tile and task of the phrases of a word more than `levels` has sizes."""
    size = len(levels) + 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = TaskContext.get().partitionId() % salts
        codes, others, held = [], [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            parts, weight = [], 0
            for part in _flushed(np.concatenate([np.zeros(0, np.uint64), *codes]), np.concatenate([np.zeros((0, size), np.uint64), *others]), hot, buckets, salt):
                parts.append(part)
                weight += part[2].nbytes + part[3].nbytes
                if weight > 1 << 23:
                    yield _blobs(parts)
                    parts, weight = [], 0
            yield _blobs(parts)

        for batch in batches:
            for words, _, _ in _runs_of(batch):
                parts = words.keys if size == 2 else gram_hashes(words.keys, size - 1)
                known = levels[-1].flags.hold(parts)
                at = np.flatnonzero(known[:-1] & known[1:]) if len(parts) > 1 else np.zeros(0, np.int64)
                for k in range(1, size):
                    at = at[words.follows[at + k]]
                single = levels[0].ids.value.of(words.keys)
                left = single[at]
                for k in range(1, size - 1):  # the id of the words before the last one
                    right = single[at + k]
                    left = np.where((left >= 0) & (right >= 0), levels[k].ids.value.of(_join(left, right)), -1)
                right = single[at + size - 1]
                dense = (left >= 0) & (right >= 0)
                i, j = left[dense].astype(np.uint64), right[dense].astype(np.uint64)
                low, side = np.uint64((1 << SIDE_BITS) - 1), np.uint64(SIDE_BITS)
                tile = (i >> side) * np.uint64(BANDS) + (j >> side)
                codes.append(tile << np.uint64(2 * SIDE_BITS) | (i & low) << side | j & low)
                rest = at[~dense]
                others.append(words.keys[rest[:, None] + np.arange(size)])
                held += len(at)
                if held >= HELD:
                    yield from flush()
                    codes, others, held = [], [], 0
        yield from flush()
        del codes, others
        release()

    return docs.mapInArrow(count, BLOB)


class Tile:
    """One tile while its counts come in: sorted coordinates, or a dense array from DENSE entries on."""

    def __init__(self):
        self.parts, self.size, self.dense = [], 0, None

    def add(self, cells: np.ndarray, counts: np.ndarray) -> None:
        if self.dense is not None:
            self.dense[cells] += counts  # a part names a cell once
            return
        self.parts.append((cells, counts))
        self.size += len(cells)
        if self.size >= DENSE and cells.ndim == 1:
            self.dense = np.zeros(CELLS, np.int64)
            for part in self.parts:
                self.add(*part)
            self.parts = []

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.dense is not None:
            cells = np.flatnonzero(self.dense)
            return cells.astype(np.uint32), self.dense[cells]
        cells, counts = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        if cells.ndim == 2:
            return _summed(cells, counts)
        cells, counts = _summed(cells[:, None], counts)
        return cells.ravel(), counts


def _merged(blobs: DataFrame, size: int, hot: np.ndarray, least: int, last: bool) -> DataFrame:
    """The sums of every tile, with its frequent cells; a hot tile keeps all its cells until the `last` sum over its salts."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None

        def done() -> list[tuple]:
            cells, counts = held.all()
            often = counts >= least if last or at[0] >= TILES or not hot[at[0]] else counts > 0
            return [(*at, cells[often], counts[often].astype(np.int64))] if often.any() else []

        for batch in batches:
            out = []
            for tile, salt, cells, counts in zip(*(text_array(batch, c) for c in ("tile", "salt", "cells", "counts")), strict=True):
                here = (tile.as_py(), 0 if last else salt.as_py())
                if here != at:
                    if held:
                        out += done()
                    at, held = here, Tile()
                cells = np.frombuffer(cells.as_py(), np.uint32) if at[0] < TILES else np.frombuffer(cells.as_py(), np.uint64).reshape(-1, size)
                raw = counts.as_py()
                held.add(cells, np.frombuffer(raw, np.int64 if len(raw) == 8 * len(cells) else np.uint32).astype(np.int64))
                if len(out) > 256:
                    yield _blobs(out)
                    out = []
            yield _blobs(out)
        yield _blobs(done() if held else [])
        del held
        release()

    by = ["tile"] if last else ["tile", "salt"]
    return blobs.repartition(*by).sortWithinPartitions(*by).mapInArrow(merge, BLOB)


def _decoded(blobs: DataFrame, levels: list[Level]) -> DataFrame:
    """k1, k2, ... (hashes of the words), left and right (ids, -1 if none), n, key (hash of the phrase)."""
    size = len(levels) + 1
    names = [f"k{k}" for k in range(1, size + 1)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tile, cells, counts in zip(*(text_array(batch, c) for c in ("tile", "cells", "counts")), strict=True):
                t, n = tile.as_py(), np.frombuffer(counts.as_py(), np.int64)
                if t < TILES:
                    cell = np.frombuffer(cells.as_py(), np.uint32).astype(np.int64)
                    left, right = (t // BANDS << SIDE_BITS) + (cell >> SIDE_BITS), (t % BANDS << SIDE_BITS) + (cell & ((1 << SIDE_BITS) - 1))
                    keys = np.concatenate([levels[-1].keys.value[left], levels[0].keys.value[right]], 1)
                else:
                    keys = np.frombuffer(cells.as_py(), np.uint64).reshape(-1, size)
                    left = right = np.full(len(n), -1)
                begin = np.arange(0, keys.size, size)
                key = range_hashes(keys.ravel(), begin, begin + size)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.ascontiguousarray(keys[:, k]).view(np.int64)) for k in range(size)), pa.array(left, pa.int64()), pa.array(right, pa.int64()), pa.array(n), pa.array(key.view(np.int64))], names=[*names, "left", "right", "n", "key"]
                )

    return blobs.mapInArrow(rows, ", ".join(f"{c} long" for c in (*names, "left", "right", "n", "key")))


def _ranked(frame: DataFrame, columns: list[str], ids: int) -> dict[str, np.ndarray]:
    """The columns of the most frequent rows, `ids` at most, by count and key."""
    found = most_frequent(frame, ids).select("n", "key", *(c for c in columns if c not in ("n", "key"))).toArrow()
    order = np.lexsort([found["key"].to_numpy(), -found["n"].to_numpy()])
    return {c: found[c].to_numpy()[order] for c in found.column_names}


def _hot_tiles(left: np.ndarray, right: np.ndarray, total: int) -> np.ndarray:
    """Tiles that expect at least DENSE occurrences, from the counts by id of both sides: their sums are split over salts."""
    band = lambda n: np.bincount(np.arange(len(n)) >> SIDE_BITS, n, BANDS)
    return (np.outer(band(left), band(right)) / max(total, 1) >= DENSE).ravel()


def frequent_phrases(docs: DataFrame, longest: int = 3, least: int = 10, ids: int = 1 << ID_BITS) -> tuple[DataFrame, list[DataFrame]]:
    """(lang, n of all words) and, for every size from 1 to `longest`, the phrases that occur `least` times (stored).

    docs: text, lang. Size 1: key, lang, word, n. Larger: k1, k2, ... (keys of the words), key, n.
    `ids`: at most so many words and phrases get ids (a broadcast of 16 bytes for each word of them).
    """
    spark = docs.sparkSession
    counted = materialize(word_counts(docs).where(f"n >= {least} or word is null"), "words")
    totals = counted.where("word is null").select("lang", "n")
    words = counted.where(f"word is not null and n >= {least}")
    if words.groupBy("key").count().where("count > 1").limit(1).count():
        raise ValueError("two frequent words have one hash")
    total = totals.agg(F.sum("n")).first()[0] or 0
    head = _ranked(words, [], ids)
    keys = head["key"].view(np.uint64)
    levels = [Level(spark, Ids(keys), keys[:, None], Flags(words.select("key")))]
    out, before = [words], head["n"]
    for size in range(2, longest + 1):
        hot = _hot_tiles(before, head["n"], total)
        salts = 1 + total // (FAN_IN * HELD)
        blobs = _counted(docs, levels, hot, 64 + (total >> 20), salts)
        sums = [materialize(_merged(blobs, size, hot, least, last=salts == 1), "tiles")]
        of_hot = F.col("tile").isin(np.flatnonzero(hot).tolist()) if hot.sum() < 1000 else F.col("tile") < TILES
        done, rest = (sums[0].where(~of_hot), sums[0].where(of_hot)) if salts > 1 else (sums[0], sums[0].limit(0))
        while salts > 1:  # a hot tile's sums, a few at a time: no task reads more, at any size
            salts = -(-salts // FAN_IN)
            sums.append(materialize(_merged(rest.withColumn("salt", (F.col("salt") % salts).cast("int")), size, hot, least, last=salts == 1), "tiles"))
            rest = sums[-1]
        frequent = _decoded(done.union(rest), levels)
        frequent = materialize(frequent, "phrases")
        discard(*sums)
        names = [f"k{k}" for k in range(1, size + 1)]
        out.append(frequent.select(*names, "key", "n"))
        if size < longest:
            top = _ranked(frequent.where("left >= 0"), ["left", "right", *names], ids)
            before = top["n"]
            levels.append(Level(spark, Ids(_join(top["left"], top["right"])), np.stack([top[c].view(np.uint64) for c in names], 1), Flags(frequent.select("key"))))
    return totals, out


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, most: int = 2000, cover: int = 50, ids: int = 1 << ID_BITS) -> DataFrame:
    """The `most` best phrases of 2 to `longest` words of each lang of `docs` (text, lang): lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), split into pieces at .,;:!? and line ends, and into words at
    blanks and tabs. n: words of the lang; a: occurrences of the phrase within pieces, overlaps
    included, `least` or more. Cut into two parts that occur l and r times, a phrase scores
    floor(1000000 * a * a / (l * r)); the cut of the lowest score counts, of equal ones the
    first. A phrase is left out if a longer one of these contains it and occurs in at least
    `cover` % of its places. Order: score and a from the largest, then the phrase by its bytes.

    A null text is empty; a null lang is `und`; every row counts, also one that repeats. No
    documents, or no phrase that is frequent, give no rows. Other columns play no part. A text
    of any length is worked off in runs of words. Words are told apart by 64-bit hashes; two
    frequent ones with one hash are an error.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit("und")).alias("lang"))
    totals, sizes = frequent_phrases(docs, longest, least, ids)
    # f of all first parts and of all last parts, from the phrases of a word less
    level = sizes[0].select(F.col("key").alias("k1"), "lang", F.col("word").alias("phrase"), "word", F.array("n").alias("firsts"), F.array("n").alias("lasts"), "n")
    found = []
    for size in range(2, longest + 1):
        keys = [f"k{k}" for k in range(1, size + 1)]
        front = level.select(*keys[:-1], "lang", F.col("phrase").alias("front"), "firsts")
        back = level.select(*(F.col(f"k{k}").alias(f"k{k + 1}") for k in range(1, size)), "word", "lasts")
        both = sizes[size - 1].select(*keys, "n").join(front, keys[:-1]).join(back, keys[1:])
        level = both.select(*keys, "lang", F.concat_ws(" ", "front", "word").alias("phrase"), "word", F.concat("firsts", F.array("n")).alias("firsts"), F.concat("lasts", F.array("n")).alias("lasts"), "n")
        level = materialize(level, "level")
        found.append(level)
    scored = []
    for size, level in enumerate(found, 2):
        cuts = []
        for k in range(1, size):
            left, right = F.element_at("firsts", k), F.element_at("lasts", size - k)
            score = F.expr(f"cast((1000000BD * cast(n as decimal(15,0)) * cast(n as decimal(15,0))) div (cast(firsts[{k - 1}] as decimal(15,0)) * cast(lasts[{size - k - 1}] as decimal(15,0))) as long)")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("cut"), left.alias("l"), right.alias("r")))
        best = level.withColumn("best", F.array_min(F.array(*cuts)))
        for longer in range(size + 1, longest + 1):
            parts = [F.struct(*(F.col(f"k{at + k}").alias(f"k{k}") for k in range(1, size + 1))) for at in range(longer - size + 1)]
            over = found[longer - 2].select("n", F.explode(F.array(*parts)).alias("p")).groupBy(*(F.col(f"p.k{k}").alias(f"k{k}") for k in range(1, size + 1))).agg(F.max("n").alias("over"))
            best = best.join(over, [f"k{k}" for k in range(1, size + 1)], "left").where(f"coalesce(100 * over < {cover} * n, true)").drop("over")
        scored.append(best.select("lang", "phrase", F.col("n").alias("a"), "best.l", "best.r", "best.score"))
    every = scored[0]
    for more in scored[1:]:
        every = every.union(more)
    every = materialize(every, "scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salts = -(-every.count() // (10 * most)) or 1  # the best of each part, then the best of those
    some = every.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(salts))).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(f"rank <= {most}")
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(f"rank <= {most}")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
