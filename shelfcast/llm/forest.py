"""Near duplicates by an LSH forest over MinHash signatures.

A signature is cut into several labels (trees). Sorted by one of them, sets that share a longer
prefix stand nearer together. Every region of sets with a common prefix is as deep as it has to
be: a short prefix does where few sets share it, a longer one where many do, so that a dense
region costs no more for each set than a sparse one. All pairs of a region of up to `leaf` sets
are candidates. In a region that is still larger at the full depth, first the neighbours in the
sorted order are candidates; when their links are known, its sets are compared in blocks, unless
two blocks are of one component, so nothing is capped.

Two sets of similarity s share d values of one of T trees with a probability of 1 - (1 - s**d)**T:
1 - 2e-7 for 0.85 at the deepest (6 of 32), more wherever the region is shallower. Candidates are
confirmed on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import connected
from shelfcast.llm.flags import Flags
from shelfcast.llm.jaccard import Similarity, _compare, _links, _side, _tokens
from shelfcast.llm.textbytes import mix, shingle_sets, slices, text_array
from shelfcast.session import discard, materialize, ship_package

TREES = 32
#: Prefix lengths at which regions are looked at; the last one is the length of a label.
DEPTHS = (2, 4, 6)
VALUES = TREES * DEPTHS[-1]
FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1 << 62, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
SPREAD = np.uint64(0x9E3779B97F4A7C15)
SKETCH = [f"s{k}" for k in range(VALUES // 64)]
KEYED = "key long, rep long, n long, " + ", ".join(f"{s} long" for s in SKETCH)
PAIRS = "a long, b long, apart int"


def furthest(like: Similarity) -> int:
    """Differing bits of two sketches, which linked sets reach with a probability below a millionth (six standard deviations)."""
    p = (1 - like.num / like.den) / 2
    return math.ceil(VALUES * p + 6 * math.sqrt(VALUES * p * (1 - p)))


def signatures(sets: list[np.ndarray], tokens: int = 1 << 16) -> np.ndarray:
    """The VALUES smallest hashes (32 bits of each) of non-empty token sets, a row for each."""
    out, at = np.empty((len(sets), VALUES), np.uint32), 0
    ends = np.cumsum([len(s) for s in sets])
    while at < len(sets):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + tokens, "right")))
        flat = np.concatenate(sets[at:to])
        begin = np.concatenate([[0], ends[at : to - 1] - (ends[at - 1] if at else 0)])
        for k, factor in enumerate(FACTORS):
            out[at:to, k] = (np.minimum.reduceat(flat * factor, begin) * SPREAD) >> np.uint64(32)
        at = to
    return out


def _signed(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n, set_id (digest of the set) and its signature (null without words)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sets = list(shingle_sets(text_array(batch, "text"), words))
            signed = iter(signatures([s for s in sets if len(s)]))
            names = [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [text_array(batch, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.string()), pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "n", "set_id", "signature"],
            )

    return docs.mapInArrow(build, "doc_id long, n long, set_id string, signature binary")


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(text_array(batch, "signature").to_pylist()), np.uint32).reshape(-1, VALUES)


def _keys(values: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(depth, keys of every row's prefix of that length in every tree), for each of DEPTHS."""
    labels = values.reshape(len(values), TREES, DEPTHS[-1]).astype(np.uint64)
    key = np.broadcast_to(mix(np.arange(1, TREES + 1, dtype=np.uint64)), labels.shape[:2])
    for depth in range(1, DEPTHS[-1] + 1):
        key = mix(key * SPREAD + labels[:, :, depth - 1])
        if depth in DEPTHS:
            yield depth, key


def _regions(sets: DataFrame, leaf: int) -> tuple[list[Flags], list[Flags]]:
    """For each of DEPTHS: the regions of 2 to `leaf` sets, and those of more (to be looked at more deeply)."""
    few, many = [], []
    for step in range(len(DEPTHS)):
        above = list(many)

        def keys(batches: Iterator[pa.RecordBatch], above=above, step=step) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches, 4096):
                alive = True
                for at, (_, key) in enumerate(_keys(_matrix(batch))):
                    if at == step:
                        yield pa.RecordBatch.from_arrays([pa.array(key[alive].ravel().view(np.int64))], names=["key"])
                        break
                    alive = above[at].hold(key) & alive

        counted = sets.select("signature").mapInArrow(keys, "key long").groupBy("key").count().where("count > 1")
        counted = materialize(counted, "regions")
        few.append(Flags(counted.where(F.col("count") <= leaf).select("key")))
        many.append(Flags(counted.where(F.col("count") > leaf).select("key")))
        discard(counted)
        if not many[-1].any:
            break
    return few, many


def _members(sets: DataFrame, few: list[Flags], many: list[Flags], crowded: bool) -> DataFrame:
    """(key, rep, n, sketch) of every set in its small regions, or in the `crowded` ones of the full depth."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 4096):
            values = _matrix(batch)
            sketch = np.packbits((values & 1).astype(np.uint8), axis=1).view(np.int64)
            reps, n, alive = text_array(batch, "rep").to_numpy(), text_array(batch, "n").to_numpy(), True
            for (depth, key), small, large in zip(_keys(values), few, many, strict=False):
                dense = large.hold(key) & alive
                chosen = dense if crowded else small.hold(key) & ~dense & alive
                if not crowded or depth == DEPTHS[-1]:
                    at = np.nonzero(chosen)[0]
                    yield pa.RecordBatch.from_arrays([pa.array(key[chosen].view(np.int64)), pa.array(reps[at]), pa.array(n[at]), *(pa.array(sketch[at, k]) for k in range(len(SKETCH)))], names=["key", "rep", "n", *SKETCH])
                alive = dense

    return sets.select("rep", "n", "signature").mapInArrow(rows, KEYED)


def _near(like: Similarity, x: str = "x", y: str = "y") -> str:
    """SQL: structs x and y may link by their sizes and sketches."""
    return f"{like.den} * least({x}.n, {y}.n) >= {like.num} * greatest({x}.n, {y}.n) and {_apart(x, y)} <= {furthest(like)}"


def _apart(x: str, y: str) -> str:
    return " + ".join(f"bit_count({x}.{s} ^ {y}.{s})" for s in SKETCH)


def _pairs_of_leaves(members: DataFrame, like: Similarity) -> DataFrame:
    """All pairs of every small region that may link. A region's list is short: larger ones were left out before."""
    held = members.groupBy("key").agg(F.collect_list(F.struct("rep", "n", *SKETCH)).alias("m")).where("size(m) > 1")
    pairs = held.select(F.expr("inline(flatten(transform(m, (p, i) -> transform(slice(m, i + 2, size(m)), q -> struct(p as x, q as y)))))"))
    return pairs.where(f"x.rep <> y.rep and {_near(like)}").select(F.greatest("x.rep", "y.rep").alias("a"), F.least("x.rep", "y.rep").alias("b"), F.expr(_apart("x", "y")).cast("int").alias("apart"))


def _facing(like: Similarity, left: tuple, right: tuple) -> pa.RecordBatch:
    """Pairs (a, b, apart) that may link, of sets (reps, sizes, sketches) held against others row by row."""
    (ra, na, sa), (rb, nb, sb) = left, right
    apart = np.bitwise_count((sa ^ sb).view(np.uint64)).sum(1, dtype=np.int32)
    fit = (apart <= furthest(like)) & (like.den * np.minimum(na, nb) >= like.num * np.maximum(na, nb)) & (ra != rb)
    a, b = ra[fit], rb[fit]
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b)), pa.array(apart[fit])], names=["a", "b", "apart"])


def _columns(batch: pa.RecordBatch) -> tuple:
    return text_array(batch, "rep").to_numpy(), text_array(batch, "n").to_numpy(), np.stack([text_array(batch, s).to_numpy() for s in SKETCH], 1)


def _neighbours(crowd: DataFrame, like: Similarity) -> DataFrame:
    """Every set of a crowded region against the one before it in the sorted order and against the first of its task."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, here = text_array(batch, "key").to_numpy(), _columns(batch)
            if last:
                keys, here = np.concatenate([last[0], keys]), tuple(np.concatenate([p, h]) for p, h in zip(last[1], here, strict=True))
            at = np.flatnonzero(keys[1:] == keys[:-1]) + 1
            first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            head = first[np.searchsorted(first, np.arange(len(keys)), "right") - 1]
            head_row = tuple(c[head[-1] : head[-1] + 1] for c in here)
            for other in (at - 1, head[at]):
                yield _facing(like, tuple(c[at] for c in here), tuple(c[other] for c in here))
            last = (np.repeat(keys[-1:], 2), tuple(np.concatenate([h, c[-1:]]) for h, c in zip(head_row, here, strict=True)))

    order = ["key", *SKETCH, "rep"]
    return crowd.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(scan, PAIRS)


def _between_components(docs: DataFrame, crowd: DataFrame, labels: DataFrame, like: Similarity, block_tokens: int = 1 << 16) -> DataFrame:
    """Links (stored) that connect what links of any pair of any crowded region connect.

    A region is sorted by component and cut into blocks of about `block_tokens` shingles. Two
    blocks are held against each other, set by set, unless both are of one component. Each
    pair of blocks is a row of its own.
    """
    known = crowd.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("key", F.coalesce("label", "rep").alias("label"), "rep", "n")
    order = ["key", "label", "rep"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, last = TaskContext.get().partitionId() << 33, 0, None
        for batch in batches:
            blocks = []
            for key, n in zip(text_array(batch, "key").to_pylist(), text_array(batch, "n").to_pylist(), strict=True):
                if key != last or held + n > block_tokens:
                    block, held, last = block + 1, 0, key
                held += n
                blocks.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), *(text_array(batch, c) for c in order)], names=["block", *order])

    blocks = known.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, "block long, key long, label long, rep long")
    blocks = materialize(blocks, "blocks")
    stats = blocks.groupBy("block", "key").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    side = lambda c: stats.select("key", *(F.col(x).alias(f"{x}_{c}") for x in ("block", "low", "high")))
    met = side("x").join(side("y"), "key").where("block_x <= block_y and not (low_x = high_x and low_y = high_y and low_x = low_y)")
    met = materialize(met.select(F.col("block_x").alias("big"), F.col("block_y").alias("small")), "met")
    wanted = materialize(blocks.join(met.select(F.col("big").alias("block")).union(met.select("small")), "block", "left_semi").select(F.col("rep").alias("h"), "block", "label"), "wanted")
    tokens = _side(_tokens(docs, wanted.select("h").distinct(), like.words), "h")
    held = wanted.join(tokens, "h").groupBy("block").agg(F.collect_list(F.struct("h", "n_h", "label", "of_h")).alias("held"))  # about block_tokens
    each = lambda name: F.transform("held", lambda h: h[name])
    blobs = held.select("block", each("h").alias("reps"), each("n_h").alias("sizes"), each("label").alias("labels"), F.flatten(each("of_h")).alias("tokens"))
    links = materialize(_compare(met, blobs, like), "links")
    discard(blocks, met, wanted)
    return links


def _best(pairs: DataFrame) -> DataFrame:
    """For each set the pair whose sketches are nearest."""
    ends = F.inline(F.array(*(F.struct(F.col(c).alias("node"), "a", "b", "apart") for c in ("a", "b"))))
    nearest = F.min_by(F.struct("a", "b"), F.struct("apart", F.xxhash64("a", "b")))
    return pairs.select(ends).groupBy("node").agg(nearest.alias("p")).select("p.a", "p.b").distinct()


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets lie in different components of `labels` (node, label)."""
    side = lambda c: labels.toDF(c, f"of_{c}")
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


def _confirmed(docs: DataFrame, pairs: DataFrame, like: Similarity) -> DataFrame:
    """The pairs (stored) whose full sets link (stored)."""
    tokens = materialize(_tokens(docs, pairs.select("a").union(pairs.select("b")), like.words), "tokens")
    links = materialize(_links(pairs, tokens, like), "links")
    discard(tokens)
    return links


def near_duplicates(docs: DataFrame, like: Similarity = Similarity(), leaf: int = 16) -> DataFrame:
    """One row per row of `docs` (doc_id long, text): doc_id, n_shingles, component_id, kept.

    Words are separated by ASCII white space after lower-casing A-Z; a text of fewer words
    than a shingle is one shingle; null and empty texts have none and link with nothing.
    component_id: the smallest doc_id reachable by links; kept: doc_id is the component's id.
    Rows that repeat a doc_id are one document with the links of all its rows. A row with a
    null doc_id links with nothing, has a null component and is kept. An empty table gives no
    rows; other columns play no part.

    `leaf`: up to so many sets a region is compared pair by pair; it sets the depth of regions
    and so the work. A link is found with the probability named above; a component whose sets
    have several links each is missed far more rarely.
    """
    ship_package(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialize(_signed(docs, like.words), "signed")
    named = rows.where("n > 0 and doc_id is not null")
    sets = materialize(named.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("signature").alias("signature")), "sets")
    member = rows.select("doc_id", "n", "set_id").join(sets.select("set_id", "rep"), "set_id", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    member = materialize(member, "members")
    discard(rows)
    # a document whose rows have several sets hangs them together
    several = member.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    same = member.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    few, many = _regions(sets, leaf)
    pairs = materialize(_pairs_of_leaves(_members(sets, few, many, crowded=False), like).distinct(), "pairs")
    crowded, near = len(many) == len(DEPTHS) and many[-1].any, pairs
    if crowded:
        crowd = materialize(_members(sets, few, many, crowded=True), "crowd")
        near = pairs.union(_neighbours(crowd, like))
    discard(sets)
    links = _confirmed(docs, materialize(_best(near), "best"), like)
    links = links.union(_confirmed(docs, materialize(_across(pairs, connected(links)), "rest"), like))
    if crowded:
        links = links.union(_between_components(docs, crowd, connected(links), like))
    final = connected(links.union(same))
    out = member.join(final.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
