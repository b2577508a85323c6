"""Prefix trie of conversations by van Emde Boas recursion.

A trie of height H is cut at half its height: the prefixes at the cut are named, the trie above
the cut and the forest below it are worked on at the same time, each cut at half its height
again, so that every depth is named after log2(H) rounds. Totals of subtrees come the other way:
a round grafts the totals of the forests of twice the height upon the tries above their cuts, to
all nodes on the way from a cut node to the top of its trie, until one trie is left.

A prefix is named by the exclusive or of 128-bit digests of its turns and their places, so the
name of a longer prefix is that of its upper part and the digest of the block below: no join
on a name, which a third of all conversations may share. A conversation of any length is rows,
never a list.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.textbytes import text_array
from shelfcast.session import discard, materialize, ship_package

NODE = ["d", "x", "y"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def ordered_turns(chats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv_id, at, part, x, y, chars) of all turns and (conv_id, part, first, before, len) of the parts they lie in.

    The turns are sorted over all tasks by conversation, turn, role and text; a turn's place in
    its conversation is at - first + before. So a conversation that holds most rows is in many parts.
    """
    turns = chats.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    name = [F.xxhash64(F.lit(seed), "role", "text").alias(n) for seed, n in ((1, "x"), (2, "y"))]
    at = F.monotonically_increasing_id()
    turns = turns.orderBy("conv_id", F.asc_nulls_first("turn"), "role", "text").select("conv_id", at.alias("at"), *name, F.char_length("text").cast("long").alias("chars"))
    turns = materialize(turns, "turns").withColumn("part", F.shiftright("at", 33))
    parts = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    own = Window.partitionBy("conv_id")  # a row for each part, not for each turn
    before = F.coalesce(F.sum("n").over(own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return turns, parts.select("conv_id", "part", "first", before.alias("before"), F.sum("n").over(own).alias("len"))


def shared_openings(chats: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that open like one of their neighbours: (conv_id, d, x, y, chars, last) of all turns, d from 1, and (conv_id, len).

    Conversation c takes its first h turns from conversation c - c % every, where h is the
    unsigned crc32 of c as text modulo `most`, and goes on with its own after its first h.
    x, y: digests of the turn and its place. Conversations without turns have a len of 0.
    """
    turns, parts = ordered_turns(chats)
    parts = materialize(parts, "parts")
    h = (F.crc32(F.col("conv_id").cast("string")) % most).alias("h")
    convs = parts.select("conv_id", "len").distinct().select("conv_id", "len", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h)
    bases = convs.where("conv_id = base").select("base", F.col("len").alias("base_len"))
    convs = convs.join(bases, "base", "left").select("conv_id", "base", "len", "h", F.least("h", F.coalesce("base_len", F.lit(0))).alias("taken"))
    convs = materialize(convs.withColumn("total", F.col("taken") + F.greatest(F.lit(0), F.col("len") - F.col("h"))), "convs")
    placed = turns.join(parts.drop("len").join(convs.drop("base", "len"), "conv_id"), ["conv_id", "part"]).withColumn("pos", F.col("at") - F.col("first") + F.col("before"))
    kept = placed.where("pos >= h").select("conv_id", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("d"), "x", "y", "chars", "total")
    first = placed.where(f"pos < {most} and conv_id % {every} = 0").select(F.col("conv_id").alias("base"), "pos", "x", "y", "chars")
    opening = convs.select("conv_id", "base", "h", "total").join(first, "base").where("pos < h").select("conv_id", (F.col("pos") + 1).alias("d"), "x", "y", "chars", "total")
    rows = kept.union(opening).select("conv_id", "d", F.xxhash64("x", "d").alias("x"), F.xxhash64("y", "d").alias("y"), "chars", (F.col("d") == F.col("total")).alias("last"))
    return materialize(rows, "rebuilt"), convs.select("conv_id", F.col("total").alias("len"))


def _named(rows: DataFrame, lengths: DataFrame, levels: int) -> DataFrame:
    """(conv_id, d, x, y): the name of every prefix, also that of no turns. Cut in halves, `levels` times."""
    level = F.explode(F.array(*(F.lit(k) for k in range(levels))))
    upper = rows.select("conv_id", (F.col("d") - 1).alias("i"), "x", "y", level.alias("level")).select("conv_id", "level", F.expr("shiftright(i, level)").alias("block"), "x", "y")
    # the blocks that reach from the top of a trie to its cut, if they are whole
    blocks = upper.where("block % 2 = 0").groupBy("conv_id", "level", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"), F.count(F.lit(1)).alias("n"))
    blocks = materialize(blocks.where("n = shiftleft(1L, level)").drop("n"), "blocks")
    names = [lengths.select("conv_id", F.lit(0).cast("long").alias("d"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))]
    for k in reversed(range(levels)):
        known = reduce(DataFrame.union, names).withColumn("block", F.shiftright("d", k))
        cut = known.join(blocks.where(F.col("level") == k).drop("level"), ["conv_id", "block"])
        names.append(materialize(cut.select("conv_id", (F.col("d") + (1 << k)).alias("d"), F.expr("x ^ bx").alias("x"), F.expr("y ^ by").alias("y")), "names"))
    return reduce(DataFrame.union, names)


def _grafted(nodes: DataFrame, names: DataFrame, levels: int) -> DataFrame:
    """The nodes with `leaves` and `saved` summed over their subtrees, in `levels` rounds."""
    for k in range(levels):
        half = 1 << k  # tops of the lower forests: half way down a block of depths
        tops = nodes.where(F.col("d").bitwiseAND(2 * half - 1) == half).groupBy(F.col("parent").alias("conv_id"), (F.col("d") - 1).alias("cut")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        way = tops.select("conv_id", F.explode(F.sequence(F.col("cut") - half + 1, F.col("cut"))).alias("d"), "l", "s")
        more = way.join(names, ["conv_id", "d"]).groupBy(*NODE).agg(F.sum("l").alias("l"), F.sum("s").alias("s"))
        sums = {to: F.col(to) + F.coalesce(add, F.lit(0)) for to, add in (("leaves", "l"), ("saved", "s"))}
        before, nodes = nodes, materialize(nodes.join(more, NODE, "left").withColumns(sums).drop("l", "s"), "nodes")
        discard(before)
    return nodes


def _joined(ends: DataFrame, most: int = 1 << 16) -> DataFrame:
    """(d, x, y, ends_sha256): hash of the ascending, comma-joined conv_ids of each node's rows.

    Sorted over all tasks and written out in parts of up to `most` ids; a node's parts are then
    hashed one after the other, so that none has to be held as a whole.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [text_array(batch, c).to_numpy() for c in NODE]
            ids = text_array(batch, "conv_id").to_numpy()
            new = np.flatnonzero(np.logical_or.reduce([c[1:] != c[:-1] for c in at])) + 1
            cuts = np.unique(np.concatenate([new, np.arange(0, len(ids), most), [len(ids)]])) if len(ids) else np.zeros(1, np.int64)
            begin = cuts[:-1]
            texts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(begin.tolist(), cuts[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c[begin]) for c in at), pa.array(ids[begin]), pa.array(texts, pa.string())], names=[*NODE, "least", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, digest = None, None
        for batch in batches:
            done = []
            for *node, ids in zip(*(text_array(batch, c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if node != held:
                    if held:
                        done.append((*held, digest.hexdigest()))
                    held, digest = node, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ids.encode())
            yield _rows(done)
        yield _rows([(*held, digest.hexdigest())] if held else [])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*done, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())], names=[*NODE, "ends_sha256"])

    order = [*NODE, "conv_id"]
    listed = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(parts, "d long, x long, y long, least long, ids string")
    return listed.repartition(*NODE).sortWithinPartitions(*NODE, "least").mapInArrow(hashes, "d long, x long, y long, ends_sha256 string")


def prefix_trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node of the trie of the sequences `rows` (conv_id, d, x, y, chars, last) of `lengths` (conv_id, len).

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, all long but the last: see `conversation_trie`. rows: d from 1
    without gaps, x and y a digest of the turn and its place, last true at a sequence's end.
    """
    ship_package(rows.sparkSession)
    longest = lengths.agg(F.max("len")).first()[0] or 0
    levels = longest.bit_length()  # depths 0 to `longest`
    names = _named(rows, lengths, levels)
    own = rows.select("conv_id", "d", F.col("x").alias("own_x"), F.col("y").alias("own_y"), "chars", "last")
    top = names.where("d = 0").join(lengths, "conv_id").select("conv_id", *NODE, F.lit(None).cast("long").alias("px"), F.lit(None).cast("long").alias("py"), F.lit(0).cast("long").alias("chars"), (F.col("len") == 0).alias("last"))
    below = names.where("d > 0").join(own, ["conv_id", "d"]).select("conv_id", *NODE, F.expr("x ^ own_x").alias("px"), F.expr("y ^ own_y").alias("py"), "chars", "last")
    names = materialize(top.union(below), "prefixes")
    nodes = names.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *(F.first(c).alias(c) for c in ("px", "py", "chars")))
    nodes = materialize(nodes, "nodes")
    counted = nodes.where("d > 0").groupBy((F.col("d") - 1).alias("d"), F.col("px").alias("x"), F.col("py").alias("y")).agg(F.count(F.lit(1)).alias("n_children"))
    above = nodes.select((F.col("d") + 1).alias("d"), F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv_id").alias("parent"))
    full = nodes.join(counted, NODE, "left").join(above, ["d", "px", "py"], "left")
    saved = F.when(F.col("d") == 0, 0).otherwise((F.col("n_convs") - 1) * F.col("chars"))
    full = full.select("conv_id", *NODE, "parent", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), F.col("n_children").isNull().cast("long").alias("leaves"), saved.alias("saved"))
    full = _grafted(materialize(full, "nodes"), names.select("conv_id", *NODE), levels)
    full = full.join(_joined(names.where("last")), NODE, "left")
    return full.select("conv_id", F.col("d").alias("depth"), F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))


def conversation_trie(chats: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """The prefix trie of the conversations `chats` (conv_id, turn, role, text) after `shared_openings`.

    A node is a distinct sequence of the first d turns (role and text), the root that of none;
    its members are the conversations that start with it. conv_id: smallest member; depth: d;
    parent_conv_id: the parent's conv_id (null for the root); n_convs: members; n_children;
    n_leaves: childless nodes of its subtree, itself included; saved_tokens: over its subtree,
    members but one times the code points of the last text; ends_sha256: of the ascending,
    comma-joined conv_ids of the members of d turns.

    Turns go by `turn`, nulls first, then by role and text, so that repeated turns have one
    order; all rows count. A null role or text is empty. Rows with a null conv_id belong to no
    conversation and are left out. A conversation may be left without turns: it is a member of
    the root. No conversations give no rows, also no root. Other columns play no part. The hash
    of one node's ids has to be taken one after the other, from parts of 65,536 ids.
    """
    return prefix_trie(*shared_openings(chats, every, most))
