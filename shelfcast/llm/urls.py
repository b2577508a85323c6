"""URL filters: rules first; all other urls by naive Bayes over segmented host and path words.

Names that are written together are split by Viterbi's algorithm under a unigram model, which
is counted over the words of all pages. The counts stay a table, of any size: every distinct
name meets those of its own substrings, is split once, and the splits are joined back to the
urls. The multinomial naive Bayes model is learned from the
urls that a rule decides; its words are hashed into a fixed number of buckets, so that the
model's size doesn't follow the input.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.textbytes import slices, text_array
from shelfcast.session import discard, materialize, ship_package

#: (verdict, host and path): a rule fits its host and all subdomains, and paths that start with its path.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
PIECE = re.compile(r"[a-z]+|[0-9]+|[^a-z0-9./:_?&=+%~,;!@-]+")
LONGEST = 24


def parse_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without `://`."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.translate(F.regexp_extract(after, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else null (equal length: the first listed)."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule in sorted(reversed(rules), key=lambda r: len(r[1])):
        own, start = rule[: rule.index("/")], rule[rule.index("/") :]
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(start))
        found, verdict = F.when(fits, F.lit(rule)).otherwise(found), F.when(fits, F.lit(kind)).otherwise(verdict)
    return found, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: the words (a-z only) of the text of all pages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                html = text_array(batch, "html").slice(at, 500)
                text = pc.ascii_lower(pc.replace_substring_regex(pc.fill_null(html, ""), r"(?s)<[^>]*>", " "))
                words = pc.value_counts(pc.list_flatten(pc.split_pattern_regex(text, r"[^a-z]+")))
                yield pa.RecordBatch.from_arrays([words.field("values").cast(pa.string()), words.field("counts")], names=["word", "n"])

    found = pages.select("html").mapInArrow(count, "word string, n long").where(f"length(word) between 2 and {LONGEST}")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


class Segmenter:
    """Splits names into the likeliest words; unknown pieces cost the more the longer they are.

    `counts` has to hold the words that stand in the names, `total` is that of all words.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self.logs = {w: log(n / total) for w, n in counts.items()}
        self.unknown = [0.0, *(log(1 / total) - 2.3 * k for k in range(1, LONGEST + 1))]

    def split(self, name: str) -> tuple[str, ...]:
        best, back = [0.0], [0]
        for end in range(1, len(name) + 1):
            score, start = max((best[a] + self.logs.get(name[a:end], self.unknown[end - a]), a) for a in range(max(0, end - LONGEST), end))
            best.append(score)
            back.append(start)
        words, end = [], len(name)
        while end:
            words.append(name[back[end] : end])
            end = back[end]
        return tuple(reversed(words))


def _pieces(host: str, path: str) -> list[tuple[str, str]]:
    """(part, piece) of host (`h:`) and path (`p:`), in order."""
    return [(part, piece) for part, text in (("h:", host), ("p:", path.lower())) for piece in PIECE.findall(text)]


def _is_name(piece: str) -> bool:
    return piece.isascii() and not piece[0].isdigit()


def splits(names: DataFrame, counts: DataFrame) -> DataFrame:
    """piece, words (an array) for every distinct `piece` of `names`, under the counts (word, n) of all words."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def substrings(batches: Iterator[pa.RecordBatch], part: int = 4096) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, words = [], []
            for name, piece in zip(text_array(batch, "name").to_pylist(), text_array(batch, "piece").to_pylist(), strict=True):
                for at in range(0, len(piece), part):  # the substrings that start in a part, of any length up to the longest word
                    here = piece[at : at + part + LONGEST - 1]
                    of = {here[a:b] for a in range(min(part, len(here) - 1)) for b in range(a + 2, min(len(here), a + LONGEST) + 1)}
                    ids += [name] * len(of)
                    words += of
                    if len(ids) > 1 << 17:
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.string())], names=["name", "word"])
                        ids, words = [], []
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(words, pa.string())], names=["name", "word"])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            rows = zip(text_array(batch, "piece").to_pylist(), text_array(batch, "known").to_pylist(), strict=True)
            found = [(p, Segmenter({k["word"]: k["n"] for k in known or ()}, total).split(p)) for p, known in rows]
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in found], pa.string()), pa.array([w for _, w in found], pa.list_(pa.string()))], names=["piece", "words"])

    # numbered once, as stored: a name isn't repeated beside each of its substrings
    names = materialize(names.select("piece").distinct().withColumn("name", F.monotonically_increasing_id()), "distinct_names")
    known = names.mapInArrow(substrings, "name long, word string").join(counts, "word").groupBy("name").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    return names.join(known, "name", "left").select("piece", "known").mapInArrow(split, "piece string, words array<string>")


def _named(parsed: DataFrame, counts: DataFrame) -> DataFrame:
    """`parsed` (row, host, path, ...) with found, the words of host and path; numbers as their number of digits."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(text_array(batch, c).to_pylist() for c in ("row", "host", "path")), strict=True)
            of = [(row, place, piece) for row, host, path in rows for place, (_, piece) in enumerate(_pieces(host, path)) if _is_name(piece)]
            yield pa.RecordBatch.from_arrays([pa.array([r for r, _, _ in of], pa.int64()), pa.array([k for _, k, _ in of], pa.int32()), pa.array([p for _, _, p in of], pa.string())], names=["row", "place", "piece"])

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(text_array(batch, c).to_pylist() for c in ("host", "path", "names")), strict=True)
            found = []
            for host, path, names in rows:
                split = {n["place"]: n["words"] for n in names or ()}
                found.append([part + w for place, (part, piece) in enumerate(_pieces(host, path)) for w in ([f"#{len(piece)}"] if piece[0].isdigit() else split.get(place, [piece]))])
            kept = [c for c in batch.schema.names if c != "names"]
            yield pa.RecordBatch.from_arrays([*(text_array(batch, c) for c in kept), pa.array(found, pa.list_(pa.string()))], names=[*kept, "found"])

    names = materialize(parsed.select("row", "host", "path").mapInArrow(pieces, "row long, place int, piece string"), "names")
    split = materialize(splits(names, counts), "splits")
    back = names.join(split, "piece").groupBy("row").agg(F.collect_list(F.struct("place", "words")).alias("names"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed.schema)
    named = materialize(parsed.join(back, "row", "left").mapInArrow(words, f"{schema}, found array<string>"), "named")
    discard(names, split)
    return named


def _bucket(word: str, buckets: int) -> int:
    return zlib.crc32(word.encode()) % buckets


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES, buckets: int = 1 << 16) -> DataFrame:
    """page_id, host, path, rule, verdict, score, words for every row of `pages` (page_id, url, html).

    A null url or one without `://` has empty host and path. verdict: the longest fitting
    rule's; without one, block if naive Bayes finds it likelier than allow (score: that
    probability), allow also if the rules decide no url of both kinds. Null pages have no
    words; all words of all pages count, however rare. A name of any length is split as a whole;
    only the words that it has are held for it. Rows that repeat are judged each for itself, a
    null page_id stays, other columns play no part, an empty table gives no rows.
    """
    spark = pages.sparkSession
    ship_package(spark)
    host, path = parse_url(F.col("url"))
    parsed = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = materialize(parsed.withColumns({"rule": rule, "by_rule": verdict}), "parsed")
    words = materialize(word_counts(pages), "words")
    named = _named(parsed, words)
    discard(parsed, words)

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, urls = np.zeros((2, buckets), np.int64), np.zeros(2, np.int64)
        for batch in batches:
            for found, v in zip(*(text_array(batch, c).to_pylist() for c in ("found", "by_rule")), strict=True):
                urls[v == "block"] += 1
                for w in found:
                    counts[int(v == "block"), _bucket(w, buckets)] += 1
        kind, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([*kind, 0, 1], pa.int64()), pa.array([*bucket, -1, -1], pa.int64()), pa.array([*counts[kind, bucket], *urls], pa.int64())], names=["kind", "bucket", "n"])

    rows = named.where("by_rule is not null").select("found", "by_rule").mapInArrow(learned, "kind long, bucket long, n long").groupBy("kind", "bucket").agg(F.sum("n").alias("n")).collect()  # two rows a bucket
    counts, urls = np.zeros((2, buckets)), np.zeros(2)
    for kind, bucket, n in rows:
        if bucket < 0:
            urls[kind] = n
        else:
            counts[kind, bucket] = n
    odds = None
    if urls.min() > 0:
        logs = np.log(counts + 0.5) - np.log(counts.sum(axis=1, keepdims=True) + 0.5 * buckets)
        odds = (logs[1] - logs[0], log(urls[1] / urls[0]))
    model = spark.sparkContext.broadcast(odds)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_array(batch, "found").to_pylist()
            sums = [-30.0 if model.value is None else model.value[1] + float(sum(model.value[0][_bucket(w, buckets)] for w in f)) for f in found]
            score = 1 / (1 + np.exp(-np.clip(sums, -30, 30)))
            verdict = [r or ("block" if s > 0 else "allow") for r, s in zip(text_array(batch, "by_rule").to_pylist(), sums, strict=True)]
            yield pa.RecordBatch.from_arrays([*(text_array(batch, c) for c in ("page_id", "host", "path", "rule")), pa.array(verdict, pa.string()), pa.array(score, pa.float64()), pa.array([" ".join(f) for f in found], pa.string())], names=["page_id", "host", "path", "rule", "verdict", "score", "words"])

    return named.mapInArrow(scored, f"page_id {dict(pages.dtypes)['page_id']}, host string, path string, rule string, verdict string, score double, words string")
