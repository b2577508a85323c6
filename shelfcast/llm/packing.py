"""Packing of tokenised documents into fixed-length sequences, shortest pack first.

The tokens of every document (with one end id) are cut into pieces of `length` and one rest.
The pieces' length histogram (at most `length` rows) is packed on the driver: lengths are
placed longest first, each into the shortest pack that has room, as whole counts of a
packing pattern. Rests of the emptiest packs are then cut into the gaps of fuller ones.
The patterns go back to the pieces by their rank among the pieces of the same length.

The plan depends on the histogram only, so its size doesn't follow the number of documents.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.textbytes import release, slices, text_array
from shelfcast.session import materialize, ship_package

SPECIAL = "<|endoftext|>"
#: The code points for which both tokenizer libraries split words alike (tests/llm compares every one).
PLAIN = r"[^\x00-ɏ]"


@dataclass(frozen=True)
class Part:
    """Tokens offset..offset+size of the pieces of `length` with ranks from `rank` on."""

    length: int
    offset: int
    size: int
    rank: int


Pattern = tuple[tuple[Part, ...], int]  # its parts; how many sequences have it


def _take(pattern: Pattern, n: int) -> tuple[Pattern, Pattern | None]:
    """The pattern's first n sequences and the others."""
    parts, count = pattern
    rest = tuple(Part(p.length, p.offset, p.size, p.rank + n) for p in parts)
    return (parts, n), ((rest, count - n) if count > n else None)


def _filled(pattern: Pattern) -> int:
    return sum(p.size for p in pattern[0])


def pack_histogram(histogram: dict[int, int], length: int) -> list[Pattern]:
    """Shortest-pack-first over a length histogram: the packing patterns with their counts."""
    by_room: dict[int, list[Pattern]] = defaultdict(list)
    for size in sorted(histogram, reverse=True):
        rank, left = 0, histogram[size]
        while left:
            room = max((r for r, packs in by_room.items() if packs and r >= size), default=None)
            if room is None:
                by_room[length - size].append(((Part(size, 0, size, rank),), left))
                break
            n = min(left, by_room[room][-1][1])
            chosen, rest = _take(by_room[room].pop(), n)
            if rest:
                by_room[room].append(rest)
            by_room[room - size].append((chosen[0] + (Part(size, 0, size, rank),), n))
            rank, left = rank + n, left - n
    return [p for room in sorted(by_room) for p in by_room[room] if p[1]]


def fill_gaps(patterns: list[Pattern], length: int, tolerance: int) -> list[Pattern]:
    """Cut the pieces of the emptiest packs into the gaps of the fuller ones.

    A gap of up to `tolerance` tokens stays. Works on whole counts; every step fills up a
    pattern or uses up a donor, so the number of steps depends on the histogram only.
    """
    done = [p for p in patterns if length - _filled(p) <= tolerance]
    open_ = sorted((p for p in patterns if length - _filled(p) > tolerance), key=_filled, reverse=True)
    while open_:
        receiver = open_.pop(0)
        if not open_ and receiver[1] == 1:
            done.append(receiver)
            break
        donor = open_.pop() if open_ else None
        if donor is None:  # the packs of one pattern fill each other
            half = receiver[1] // 2
            receiver, donor = _take(receiver, receiver[1] - half)
        n = min(receiver[1], donor[1])
        receiver, more = _take(receiver, n)
        donor, others = _take(donor, n)
        gap, moved, kept = length - _filled(receiver), [], []
        for p in donor[0]:
            size = min(gap, p.size)
            if size:
                moved.append(Part(p.length, p.offset, size, p.rank))
            if size < p.size:
                kept.append(Part(p.length, p.offset + size, p.size - size, p.rank))
            gap -= size
        full = (receiver[0] + tuple(moved), n)
        (done if gap <= tolerance else open_).append(full)
        open_ += [x for x in (more, others, (tuple(kept), n) if kept else None) if x]
        open_.sort(key=_filled, reverse=True)
    return done


def _encoder(tokenizer_json: str, ranks_file: str | None):
    """text -> ids as unsigned 32-bit; `ranks_file`: the same vocabulary for the faster library."""
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(tokenizer_json)
    exact = lambda text: np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    if ranks_file is None:
        return exact
    import base64
    import re

    import public_tokenizers
    import tiktoken

    with open(ranks_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    other = re.compile(PLAIN)

    def encode(text: str) -> np.ndarray:
        if SPECIAL in text or other.search(text):
            return exact(text)
        return np.asarray(fast.encode_to_numpy(text, disallowed_special=()), np.uint32)

    return encode


def pieces(docs: DataFrame, length: int, end_id: int, tokenizer_json: str, ranks_file: str | None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, and the ids of a rest."""
    ship_package(docs.sparkSession)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_json, ranks_file)
        for batch in slices(batches):
            rows: list[list] = [[], [], [], [], [], []]
            for doc, text in zip(text_array(batch, "doc_id").to_pylist(), text_array(batch, "text"), strict=True):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end_id))
                raw = ids.astype("<u4").tobytes()
                for start in range(0, len(ids), length):
                    one = raw[4 * start : 4 * (start + length)]
                    size = len(one) // 4
                    for column, value in zip(rows, (doc, start, size, zlib.crc32(one), len(ids), one if size < length else None), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in rows[:5]), pa.array(rows[5], pa.binary())], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
        del encode
        release()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def _table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Rows of longs by way of Arrow: a list of tuples would start Python workers of another kind on the executors."""
    columns = zip(*rows, strict=True) if rows else [[] for _ in names]
    return spark.createDataFrame(pa.table([pa.array(c, pa.int64()) for c in columns], names=names))


def pack(docs: DataFrame, length: int = 1024, end_id: int = 0, tolerance: int = 32, tokenizer_json: str = "", ranks_file: str | None = None, part_rows: int = 16384) -> DataFrame:
    """Pack `docs` (doc_id, text; other columns are ignored) into sequences of at most `length` ids.

    One row per piece: doc_id, start (the document's ids before it), length, ids_crc32,
    doc_tokens, sequence_id, offset. Pieces of a sequence lie gapless from offset 0.
    Null and empty texts are a single end id. Rows that repeat, also with the same doc_id,
    are packed each for itself; a null doc_id stays null. An empty table gives no rows.

    `tolerance`: tokens of a gap for which no piece is cut. `part_rows`: pieces of equal length (a
    third of all rows may have the same) are ranked in parts of about so many rows, whatever the
    size of the input; only rows that repeat as a whole stay in one part. The driver gets one
    number per length; where each part's ranks begin is a running sum in Spark.
    """
    spark = docs.sparkSession
    found = materialize(pieces(docs, length, end_id, tokenizer_json, ranks_file), "pieces")
    histogram = dict(sorted(map(tuple, found.groupBy("length").count().collect())))  # at most `length` rows
    patterns = fill_gaps(pack_histogram(histogram, length), length, tolerance)

    plan, first = [], 0
    for parts, count in patterns:
        offset = 0
        for p in parts:
            plan.append((p.length, p.offset, p.size, p.rank, p.rank + count, first - p.rank, offset))
            offset += p.size
        first += count
    cut = sorted({p[0] for p in plan if p[0] != p[2]})
    table = _table(spark, plan, ["length", "cut_at", "size", "low", "high", "shift", "offset"])
    shares = _table(spark, [(size, -(-n // part_rows)) for size, n in histogram.items()], ["length", "parts"])

    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("parts")).alias("part")
    parted = found.join(F.broadcast(shares), "length")  # at most `length` rows
    counts = materialize(parted.groupBy("length", part).count(), "parts")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))  # one row for about part_rows pieces
    ranked = (
        parted.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", part, F.when(F.col("length").isin(cut), F.col("ids")).alias("ids"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")) - 1)
        .join(starts, ["length", "part"])
        .withColumn("rank", F.col("rank") + F.col("before"))
    )
    placed = ranked.join(F.broadcast(table), "length").where("low <= rank and rank < high")  # rows by patterns
    return placed.select("doc_id", (F.col("start") + F.col("cut_at")).alias("start"), "size", "ids_crc32", "doc_tokens", (F.col("rank") + F.col("shift")).alias("sequence_id"), "offset", F.when(F.col("size") < F.col("length"), F.substring("ids", 4 * F.col("cut_at") + 1, 4 * F.col("size"))).alias("ids")).select(
        "doc_id", "start", F.col("size").alias("length"), F.when(F.col("ids").isNull(), F.col("ids_crc32")).otherwise(F.crc32("ids")).alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
