"""Benchmark decontamination by winnowing.

Both sides keep the smallest of every `9` consecutive 5-gram hashes, so that each shared run
of 13 words shares at least one kept fingerprint (5 + 9 - 1 = 13). Fingerprints of documents
first meet a bitmap of the benchmark's (fixed size, whatever the benchmark's), then the
benchmark's fingerprints in a join. Hits are extended to every 13-word window around them,
and these windows are joined with the benchmark's windows, which leaves the exact ones.
Items shorter than a window are one window of their own length, and are matched as that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.flags import without
from shelfcast.llm.textbytes import ALNUM_WORD, gram_hashes, list_column, range_hashes, release, runs, text_array, word_hashes
from shelfcast.session import materialize, ship_package

WINDOW = 13
GRAM = 5


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of the (rightmost) smallest hash of every `width` consecutive ones; of all, if fewer."""
    n = len(hashes)
    if n <= width:
        return np.array([n - 1 - int(np.argmin(hashes[::-1]))], np.int64) if n else np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(hashes, width)[:, ::-1]
    return np.unique(np.arange(width - 1, n) - view.argmin(axis=1))


def winnow_all(grams: np.ndarray, bounds: np.ndarray, k: int, width: int) -> np.ndarray:
    """Kept positions over many texts at once: windows inside one text only."""
    n = np.diff(bounds) - k + 1  # grams of every text
    long = np.flatnonzero(n >= width)
    if not len(grams) or not len(long):
        return np.zeros(0, np.int64)
    low = grams.copy()
    for step in (1, 2, 4):  # smallest of 2, 4, 8, and then of `width`, from each position on
        low[:-step] = np.minimum(low[:-step], low[step:])
    rest = width - 8
    low[: len(low) - rest] = np.minimum(low[: len(low) - rest], low[rest:])
    count = n[long] - width + 1
    begin = np.repeat(bounds[:-1][long] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
    # a window's smallest hash: its rightmost place, found by looking for equal values from the right
    smallest, at, open_ = low[begin], np.full(len(begin), -1, np.int64), np.ones(len(begin), bool)
    for shift in range(width - 1, -1, -1):
        found = open_ & (grams[begin + shift] == smallest)
        at[found] = begin[found] + shift
        open_ &= ~found
    return np.unique(at)


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def _fingerprints(batches, columns, short_lengths, bitmap, bits):
    """Per text: number of words, and for each kept fingerprint its hash and the windows around it."""
    width, before = WINDOW - GRAM + 1, WINDOW - GRAM
    for batch in batches:
        texts = text_array(batch, "text")
        for first, end, data, offs in runs(texts):
            words, bounds = word_hashes(data, offs, ALNUM_WORD)
            n = np.diff(bounds)
            grams, windows = gram_hashes(words, GRAM), gram_hashes(words, WINDOW)
            at = winnow_all(grams, bounds, GRAM, width)
            if bitmap is not None:
                at = at[bitmap[(grams[at] >> np.uint64(64 - bits)).astype(np.int64)]]
            of = np.searchsorted(bounds, at, "right") - 1
            rows: list = [[] for _ in range(end - first)]
            for p, d in zip(at.tolist(), of.tolist(), strict=True):
                a, b = max(p - before, int(bounds[d])), min(p, int(bounds[d + 1]) - WINDOW)
                rows[d].append((int(_signed(grams[p : p + 1])[0]), a - int(bounds[d]), _signed(windows[a : b + 1]).tolist(), WINDOW))
            for m, wanted in short_lengths:
                if len(words) < m:
                    continue
                spans = gram_hashes(words, m)
                hit = np.flatnonzero(wanted[(spans >> np.uint64(64 - bits)).astype(np.int64)])
                of = np.searchsorted(bounds, hit, "right") - 1
                for p, d in zip(hit.tolist(), of.tolist(), strict=True):
                    if p + m <= bounds[d + 1]:
                        h = int(_signed(spans[p : p + 1])[0])
                        rows[d].append((h, p - int(bounds[d]), [h], m))
            kind = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("windows", pa.list_(pa.int64())), ("words", pa.int64())]))
            names = ("hash", "at", "windows", "words")
            yield pa.RecordBatch.from_arrays(
                [*(text_array(batch, c).slice(first, end - first) for c in columns), pa.array(n, pa.int64()), pa.array([[dict(zip(names, r, strict=True)) for r in row] for row in rows], kind)],
                names=[*columns, "n_words", "hits"],
            )


def _item_marks(batches):
    """Per item: words, kept fingerprints, windows (a short item: its whole length as both)."""
    width = WINDOW - GRAM + 1
    for batch in batches:
        for first, end, data, offs in runs(text_array(batch, "text")):
            words, bounds = word_hashes(data, offs, ALNUM_WORD)
            n = np.diff(bounds)
            grams, windows = gram_hashes(words, GRAM), gram_hashes(words, WINDOW)
            at = winnow_all(grams, bounds, GRAM, width)
            whole = range_hashes(words, bounds[:-1], bounds[1:])
            marks, kept = [], []
            for i, size in enumerate(n.tolist()):
                a = int(bounds[i])
                if size >= WINDOW:
                    kept.append(grams[at[(at >= a) & (at < a + size)]])
                    marks.append(windows[a : a + size - WINDOW + 1])
                else:
                    kept.append(whole[i : i + 1][: int(size > 0)])
                    marks.append(kept[-1])
            yield pa.RecordBatch.from_arrays([text_array(batch, "item_id").slice(first, end - first), pa.array(n, pa.int64()), list_column(kept), list_column(marks)], names=["item_id", "n", "prints", "windows"])


def _bitmap(prints: DataFrame, bits: int) -> np.ndarray:
    """The set of the hashes' top bits: 2**bits flags, put together by Spark in words of 32."""
    top = F.shiftrightunsigned("hash", 64 - bits)
    words = prints.select((F.shiftright(top, 5)).alias("word"), (top % 32).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("flags"))
    flags = np.zeros(1 << (bits - 5), np.uint32)
    found = words.toArrow()  # at most 2**(bits - 5) rows of 16 bytes
    flags[found["word"].to_numpy()] = found["flags"].to_numpy()
    return flags


def find_windows(docs: DataFrame, items: DataFrame, keys: list[str], bits: int = 24) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(per document its keys, n_words and row number `at_row`; hit windows at_row, start, words, window; window to item_id)."""
    spark = docs.sparkSession
    ship_package(spark)
    marks = materialize(items.select("item_id", "text").mapInArrow(_item_marks, f"item_id {dict(items.dtypes)['item_id']}, n long, prints array<long>, windows array<long>"), "items")
    lengths = sorted(r["n"] for r in marks.where(f"n between 1 and {WINDOW - 1}").select("n").distinct().collect())  # at most 12
    long_prints = marks.where(f"n >= {WINDOW}").select(F.explode("prints").alias("hash"))
    prints = marks.where("n > 0").select(F.explode("prints").alias("hash"), F.least("n", F.lit(WINDOW)).alias("words")).distinct()
    shared = spark.sparkContext.broadcast((_bitmap(long_prints, bits), [(m, _bitmap(marks.where(F.col("n") == m).select(F.explode("prints").alias("hash")), bits)) for m in lengths]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flags(words):
            return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)

        long, short = shared.value
        yield from _fingerprints(batches, keys, [(m, flags(w)) for m, w in short], flags(long), bits)
        release()

    types = dict(docs.dtypes)
    schema = ", ".join([*(f"`{k}` {types[k]}" for k in keys), "n_words long", "hits array<struct<hash:long,at:long,windows:array<long>,words:long>>"])
    scanned = docs.select(*keys, "text").mapInArrow(scan, schema)
    seen = materialize(scanned.withColumn("at_row", F.monotonically_increasing_id()), "fingerprints")  # numbered once, as stored
    hits = seen.where(F.size("hits") > 0).select("at_row", F.explode("hits").alias("hit")).select("at_row", "hit.*")
    opened = hits.join(prints, ["hash", "words"], "left_semi").select("at_row", "words", F.posexplode("windows").alias("i", "window"), "at").select("at_row", (F.col("at") + F.col("i")).alias("start"), "words", "window").distinct()
    known = marks.where("n > 0").select("item_id", F.explode("windows").alias("window"), F.least("n", F.lit(WINDOW)).alias("words")).distinct()
    real = opened.join(known.select("window", "words").distinct(), ["window", "words"], "left_semi")
    return seen.drop("hits"), real, known


def contamination(docs: DataFrame, items: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One row per row of `docs` (doc_id, text): the keys, n_words, n_hit, n_items, items_sha256, contaminated.

    n_hit: words inside any occurrence of a window of `items` (item_id, text); n_items: items
    with occurring windows; contaminated: n_hit > 0 and 20 * n_hit >= n_words. Null and empty
    texts have no words; an item without words has no window. Repeated rows are judged each
    for itself, repeated items (same item_id) count once, a null item_id counts as an empty
    string in the digest. Without items nothing is hit. `keys`: columns that are kept
    (default doc_id); other columns of either table play no part.
    """
    keys = keys or ["doc_id"]
    seen, real, known = find_windows(docs, items, keys)
    real = materialize(real, "hits")
    by_start = Window.partitionBy("at_row").orderBy("start", "end")
    spans = real.select("at_row", "start", (F.col("start") + F.col("words")).alias("end")).groupBy("at_row", "start").agg(F.max("end").alias("end"))
    spans = spans.withColumn("covered", F.coalesce(F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    n_hit = spans.groupBy("at_row").agg(F.sum(F.greatest(F.lit(0), F.col("end") - F.greatest("start", "covered"))).alias("n_hit"))

    # windows with the same items are one class; documents with the same classes share one list of items
    ids = known.select("window", "words", F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")).distinct()
    classes = ids.groupBy("window", "words").agg(F.sort_array(F.collect_set("item")).alias("in_items")).withColumn("class", F.sha2(F.array_join("in_items", ","), 256))
    # hot windows: the documents' side is dealt by row, so the classes (one row per window) are what is looked up
    found = real.select("at_row", "window", "words").distinct().join(classes.select("window", "words", "class"), ["window", "words"]).groupBy("at_row").agg(F.sort_array(F.collect_set("class")).alias("of"))
    found = found.withColumn("lists", F.sha2(F.array_join("of", ","), 256))
    lists = found.groupBy("lists").agg(F.first("of").alias("of")).select("lists", F.explode("of").alias("class"))
    items_of = lists.join(classes.select("class", "in_items").distinct(), "class").select("lists", F.explode("in_items").alias("item")).groupBy("lists").agg(F.sort_array(F.collect_set("item")).alias("all"))
    digests = items_of.select("lists", F.size("all").cast("long").alias("n_items"), F.sha2(F.array_join("all", ","), 256).alias("items_sha256"))
    per_row = n_hit.join(found.select("at_row", "lists"), "at_row").join(digests, "lists").drop("lists")
    out = seen.join(per_row, "at_row", "left").drop("at_row")
    n_hit, empty = F.coalesce("n_hit", F.lit(0)).cast("long"), F.sha2(F.lit(""), 256)
    return out.select(
        *keys, "n_words", n_hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items_sha256", empty).alias("items_sha256"), ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of `docs` (doc_id, text), with all columns, that aren't contaminated by `items` (item_id, text).

    A row goes if its own text is contaminated: of rows that repeat a doc_id, also a null one,
    each is judged for itself. Null and empty texts stay; without items all rows stay.
    """
    mark = "text_mark"
    while mark in docs.columns:
        mark += "_"
    marked = docs.withColumn(mark, F.xxhash64("text"))
    bad = contamination(marked, items, ["doc_id", mark]).where("contaminated")
    return without(marked, bad, ["doc_id", mark]).drop(mark)
