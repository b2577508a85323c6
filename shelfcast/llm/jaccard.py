"""Exact n-gram Jaccard join with a token-group matrix, and the components of its links.

Documents with equal shingle sets are one set. Sets that share a smallest hash are a family;
those that really link with its head are known to be connected. Groups are such connected
sets, the rest of a family, or a set alone, in parts of bounded size. The matrix holds which
tokens stand in the union of each group's leading tokens (those that two linked sets must
share in part, rare ones first). The number of tokens that two groups share there bounds the
overlap of any two of their sets; only pairs of groups that qualify are opened and compared
set by set. Groups of one known component are never compared, and of an opened pair only
the links that connect something come back: a large group of copies costs its size, not
its square.

Texts are hashed again for every step that needs tokens, instead of being stored as tokens:
the hashing is cheaper than moving eight bytes for every word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import connected, contracted
from shelfcast.llm.flags import without
from shelfcast.llm.labels import most_frequent
from shelfcast.llm.textbytes import list_column, release, shingle_sets, slices, text_array
from shelfcast.session import discard, materialize, ship_package

#: Odd multipliers for a set's smallest hashes; sets meet by the first FAMILIES of them.
KEYS = tuple(int(m) | 1 for m in np.random.Generator(np.random.PCG64(5)).integers(1 << 62, 1 << 63, 16, dtype=np.uint64))
FAMILIES = 4


@dataclass(frozen=True)
class Similarity:
    """Sets a and b link when den * |a and b| >= num * |a or b|."""

    words: int = 5
    num: int = 8
    den: int = 10

    def probe(self, n: int) -> int:
        """Leading tokens of a set among which it meets every linked set that isn't larger."""
        return n - -(-self.num * n // self.den) + 1


def _common_tokens(docs: DataFrame, words: int, least: int, most: int) -> np.ndarray:
    """The tokens of the largest counts, `most` at most, of those that stand in `least` texts of a batch.

    Only the order of tokens depends on it, never a result: any order is right, and this one
    puts tokens that many documents share last.
    """

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = [np.zeros(0, np.uint64), *shingle_sets(text_array(batch, "text"), words)]
            for part in range(8):  # by the hashes' top bits, to sort an eighth at a time
                some = np.concatenate([t[np.searchsorted(t, np.uint64(part << 61)) : np.searchsorted(t, np.uint64((part + 1 << 61) - 1), "right")] for t in every])
                tokens, counts = np.unique(some, return_counts=True)
                often = counts >= least
                yield pa.RecordBatch.from_arrays([pa.array(tokens[often].view(np.int64)), pa.array(counts[often], pa.int64())], names=["token", "n"])
            del every, some, tokens, counts
        release()

    found = docs.select("text").mapInArrow(local, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = most_frequent(found, most).select("token").collect()  # at most `most`
    return np.sort(np.array([r[0] for r in rows], np.int64).view(np.uint64))


def _is_in(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _sets(docs: DataFrame, like: Similarity, common) -> DataFrame:
    """doc_id, n, core (tokens that are frequent), set_id (digest of the set) and keys."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, core, digests, keys = [], [], [], []
            for tokens in shingle_sets(text_array(batch, "text"), like.words):
                n.append(len(tokens))
                digests.append(hashlib.blake2b(tokens.tobytes(), digest_size=16).hexdigest())
                keys.append([(tokens * np.uint64(m)).min() for m in KEYS] if len(tokens) else [])
                core.append(int(_is_in(tokens, common.value).sum()))
            yield pa.RecordBatch.from_arrays(
                [text_array(batch, "doc_id"), pa.array(n, pa.int64()), pa.array(core, pa.int64()), pa.array(digests, pa.string()), list_column([np.array(k, np.uint64) for k in keys])],
                names=["doc_id", "n", "core", "set_id", "keys"],
            )

    return docs.mapInArrow(build, "doc_id long, n long, core long, set_id string, keys array<long>")


def _sets_of(docs: DataFrame, wanted: DataFrame, words: int, bits: int, part) -> DataFrame:
    """rep, n and `part` of the tokens of the documents whose ids are in `wanted` (one column), and of some others.

    A bitmap of fixed size keeps most others from being hashed; the caller joins the exact ids.
    """
    word = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - bits)
    flags = np.zeros(1 << (bits - 5), np.uint32)
    parts = wanted.select(F.col(wanted.columns[0]).alias("doc_id")).select(F.shiftright(word, 5).alias("word"), (word % 32).cast("int").alias("bit")).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("flags"))
    found = parts.toArrow()  # at most 2**(bits - 5) rows of 16 bytes
    flags[found["word"].to_numpy()] = found["flags"].to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(flags)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(shared.value.view(np.uint8), bitorder="little").view(bool)
        for batch in slices(batches):
            batch = batch.filter(pa.array(seen[text_array(batch, "place").to_numpy()]))
            sets = list(shingle_sets(text_array(batch, "text"), words))
            yield pa.RecordBatch.from_arrays([text_array(batch, "doc_id"), pa.array([len(s) for s in sets], pa.int64()), list_column([part(s) for s in sets])], names=["rep", "n", "tokens"])

    found = docs.select("doc_id", word.alias("place"), "text").mapInArrow(build, "rep long, n long, tokens array<long>")
    return found.where("n > 0")


def _tokens(docs: DataFrame, wanted: DataFrame, words: int, bits: int = 24) -> DataFrame:
    """rep, n and all tokens of the documents whose ids are in `wanted` (one column), and of some others."""
    return _sets_of(docs, wanted, words, bits, lambda tokens: tokens)


def _leading(docs: DataFrame, reps: DataFrame, like: Similarity, common, bits: int = 24) -> DataFrame:
    """(rep, token) for the leading tokens, in the common order, of the sets of `reps` (one column, rep)."""

    def leading(tokens: np.ndarray) -> np.ndarray:
        often = _is_in(tokens, common.value)
        return np.concatenate([tokens[~often], tokens[often]])[: like.probe(len(tokens))]

    found = _sets_of(docs, reps, like.words, bits, leading).join(reps, "rep", "left_semi")
    return found.select("rep", F.explode("tokens").alias("token"))


def _overlap(a: str, b: str):
    return F.size(F.array_intersect(a, b)).cast("long")


def _side(tokens: DataFrame, name: str) -> DataFrame:
    """The tokens under one side's names; in one form, so that a query deals them out only once."""
    return tokens.select(F.col("rep").alias(name), F.col("n").alias(f"n_{name}"), F.col("tokens").alias(f"of_{name}"))


def _links(pairs: DataFrame, tokens: DataFrame, like: Similarity) -> DataFrame:
    """Those of the pairs (a, b) whose sets link."""
    both = pairs.join(_side(tokens, "a"), "a").join(_side(tokens, "b"), "b").where(like.den * F.least("n_a", "n_b") >= like.num * F.greatest("n_a", "n_b"))
    shared = both.select("a", "b", "n_a", "n_b", _overlap("of_a", "of_b").alias("shared"))
    return shared.where(like.den * F.col("shared") >= like.num * (F.col("n_a") + F.col("n_b") - F.col("shared"))).select("a", "b")


def _ceil_div(a: str, b: int) -> str:
    return f"(({a}) + {b - 1}L) div {b}L"


def _can_link(like: Similarity, least: str, large: str, low: str, met: str) -> str:
    """SQL: sets may link of which the larger has `least` to `large` tokens and the smaller `low` at least.

    `met` of their leading tokens are the same. In the common order one of the two leading
    parts ends first; its tokens that aren't in the other part aren't in the other set. Such
    a part is of n - ceil(num * n / den) + 1 tokens. For a larger set of n tokens the bound is
    sharpest at the smallest partner, max(low, ceil(num * n / den)). Both of its terms are
    rounded up, so that it isn't monotone in n; without rounding it falls by
    num**2 / (den * (den + num)) for every token less, and rounding makes up for less than one.
    """
    bounds = []
    for step in range(like.den * (like.den + like.num) // like.num**2 + 1):
        n = f"greatest({large} - {step}L, {least})"
        part = _ceil_div(f"{like.num}L * {n}", like.den)
        bounds.append(f"{part} - ({_ceil_div(f'{like.num}L * ({n} + greatest({low}, {part}))', like.den + like.num)})")
    return f"{met} - 1 + {f'greatest({", ".join(bounds)})' if len(bounds) > 1 else bounds[0]} >= 0"


def _kin(sets: DataFrame) -> DataFrame:
    """Pairs of a set (rep) and the head of each family that it shares a smallest hash with.

    The head is the set of which most tokens are frequent, as near to all others as any.
    With n, head_n and met, how many of their smallest hashes are the same (an estimate of
    their similarity, by which only the work is planned).
    """
    keyed = sets.select("rep", "n", "core", F.posexplode(F.slice("keys", 1, FAMILIES)).alias("which", "key"))
    central = F.struct((F.col("core") / F.col("n")).alias("share"), "n", F.col("rep"))
    heads = keyed.groupBy("which", "key").agg(F.max_by("rep", central).alias("head"), F.count(F.lit(1)).alias("size")).where("size > 1")
    pairs = keyed.select("rep", "which", "key").join(heads, ["which", "key"]).where("rep <> head").select("rep", "head").distinct()
    pairs = materialize(pairs, "pairs")
    own = sets.select("rep", "n", "keys")
    # the same deal of the sets serves both sides: the few heads are picked out of it
    other = own.join(pairs.select(F.col("head").alias("rep")), "rep", "left_semi").toDF("head", "head_n", "head_keys")
    both = pairs.join(own, "rep").join(other, "head")
    same = F.size(F.filter(F.zip_with("keys", "head_keys", lambda a, b: a == b), lambda x: x))
    return both.select("rep", "head", "n", "head_n", F.size("keys").alias("of"), same.alias("met"))


def _stars(kin: DataFrame, like: Similarity) -> DataFrame:
    """Pairs that are worth a comparison: most of their smallest hashes are the same."""
    fit = kin.where(like.den * F.least("n", "head_n") >= like.num * F.greatest("n", "head_n")).where("5 * met >= 3 * of")
    return fit.select(F.greatest("rep", "head").alias("a"), F.least("rep", "head").alias("b"))


def _grouped(sets: DataFrame, kin: DataFrame, labels: DataFrame, group_tokens: int) -> DataFrame:
    """rep, n, label and gid, the group: sets that are known to link, else those near one head, else alone.

    Any partition is right. Groups hold sets of about one size (10 %), which makes the bounds
    sharp, and are split into parts of about `group_tokens` tokens.
    """
    near = kin.where("10 * met >= 3 * of")
    heads = near.select(F.col("head").alias("rep"), "head", F.lit(2.0).alias("share")).distinct()
    family = near.select("rep", "head", (F.col("met") / F.col("of")).alias("share")).union(heads).groupBy("rep").agg(F.max_by("head", F.struct("share", "head")).alias("family"))
    named = sets.select("rep", "n").join(labels.withColumnRenamed("node", "rep"), "rep", "left").join(family, "rep", "left")
    name = F.when(F.col("label").isNotNull(), F.xxhash64(F.lit(1), "label")).when(F.col("family").isNotNull(), F.xxhash64(F.lit(2), "family")).otherwise(F.xxhash64(F.lit(3), "rep"))
    name = F.xxhash64(name, F.floor(F.log("n") / F.log(F.lit(1.1))))
    named = materialize(named.select("rep", "n", F.coalesce("label", "rep").alias("label"), name.alias("name")), "named")
    sized = named.groupBy("name").agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("size")).where(F.col("size") > 1)
    part = F.pmod(F.xxhash64("rep"), F.ceil(F.coalesce("tokens", F.lit(1)) / group_tokens))
    return named.join(sized, "name", "left").select("rep", "n", "label", F.xxhash64("name", part).alias("gid"))


def _by_token(group: dict) -> dict:
    """The group with its tokens in order, and the set of each."""
    order = np.argsort(group["tokens"], kind="stable")
    return group | {"sorted": group["tokens"][order], "owner": np.repeat(np.arange(len(group["reps"])), group["sizes"])[order]}


def _forest(like: Similarity, big: dict, small: dict) -> list[tuple[int, int]]:
    """Links between the sets of two groups (or within one), as many as connect what they connect."""
    reps = np.concatenate([big["reps"], small["reps"]])
    where = {r: i for i, r in enumerate(dict.fromkeys(reps.tolist()))}
    root = list(range(len(where)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    known: dict[int, int] = {}
    for rep, label in zip(reps.tolist(), [*big["labels"].tolist(), *small["labels"].tolist()], strict=True):
        root[find(where[rep])] = find(known.setdefault(label, where[rep]))
    tokens, owner = big["sorted"], big["owner"]
    out, ends = [], np.cumsum(small["sizes"])
    for i, (rep, n, end) in enumerate(zip(small["reps"].tolist(), small["sizes"].tolist(), ends.tolist(), strict=True)):
        own = small["tokens"][end - n : end]
        low, high = np.searchsorted(tokens, own, "left"), np.searchsorted(tokens, own, "right")
        size = high - low
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)
        shared = np.bincount(owner[at], minlength=len(big["reps"]))
        for j in np.flatnonzero(like.den * shared >= like.num * (n + big["sizes"] - shared)).tolist():
            a, b = find(where[rep]), find(where[int(big["reps"][j])])
            if a != b:
                root[a] = b
                out.append((rep, int(big["reps"][j])))
    return out


def _compare(pairs: DataFrame, blobs: DataFrame, like: Similarity, partners: int = 64) -> DataFrame:
    """Links that connect what the pairs of groups (big, small) connect.

    The larger group is sent once for every `partners` smaller ones that are held against it.
    """
    many = pairs.groupBy("big").agg(F.ceil(F.count(F.lit(1)) / partners).alias("parts"))
    dealt = pairs.join(many, "big").withColumn("part", F.pmod(F.xxhash64("small"), F.col("parts")))
    inner = blobs.toDF("small", *blobs.columns[1:])
    right = dealt.select("big", "part", "small").join(inner, "small").drop("small")
    left = many.select("big", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(blobs.toDF("big", *blobs.columns[1:]), "big")

    def rows(table: pa.Table):
        for i in range(table.num_rows):
            yield {c: table.column(c).combine_chunks()[i].values.to_numpy(zero_copy_only=False) for c in ("reps", "sizes", "labels", "tokens")}

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [pair for big in map(_by_token, rows(left)) for small in rows(right) for pair in _forest(like, big, small)]
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    left, right = left.toDF(*left.columns), right.toDF(*right.columns)  # columns of their own on either side
    return left.groupBy("big", "part").cogroup(right.groupBy("big", "part")).applyInArrow(compare, "a long, b long")


def _open_groups(docs: DataFrame, sets: DataFrame, kin: DataFrame, labels: DataFrame, like: Similarity, common, group_tokens: int) -> DataFrame:
    """Links (stored) that connect whatever links between sets of different `labels` (node, label) connect."""
    leading = materialize(_leading(docs, sets.select("rep"), like, common), "leading")
    shared = leading.groupBy("token").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high").select("token")
    rows = leading.join(shared, "token", "left_semi")
    grouped = materialize(_grouped(sets, kin, labels, group_tokens), "groups")
    stats = materialize(grouped.groupBy("gid").agg(F.min("n").cast("int").alias("low"), F.max("n").cast("int").alias("high"), F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("size"), F.min("label").alias("first"), F.max("label").alias("last")), "stats")
    # the matrix: which tokens stand in the union of each group's leading tokens, and if in several sets
    sized = grouped.select("rep", "gid").join(stats.select("gid", "low", "high"), "gid")
    matrix = rows.join(sized, "rep").groupBy("token", "gid").agg(F.first("low").alias("low"), F.first("high").alias("high"), (F.count(F.lit(1)) > 1).alias("several"))
    matrix = materialize(matrix, "matrix")
    discard(leading)

    x, y = (matrix.select("token", F.col("gid").alias(side), F.col("low").alias(f"low_{side}"), F.col("high").alias(f"high_{side}")) for side in ("x", "y"))
    fits = f"{like.den}L * high_x >= {like.num}L * low_y and {like.den}L * high_y >= {like.num}L * low_x"
    sides = [F.first(c).alias(c) for c in ("low_x", "high_x", "low_y", "high_y")]
    across = x.join(y, "token").where("x < y").where(fits).groupBy("x", "y").agg(F.count(F.lit(1)).alias("met"), *sides)
    within = matrix.where("several").select(*(F.col(c).alias(f"{c}_{side}" if c != "gid" else side) for c in ("gid", "low", "high") for side in ("x", "y"))).groupBy("x", "y").agg(F.count(F.lit(1)).alias("met"), *sides)
    met = across.union(within).withColumns({"least": F.greatest("low_x", "low_y"), "large": F.greatest("high_x", "high_y"), "low": F.least("low_x", "low_y")})
    met = met.where(_can_link(like, "least", "large", "low", "met")).select("x", "y")
    one = lambda side: stats.select(F.col("gid").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in ("tokens", "size", "first", "last")))
    met = met.join(one("x"), "x").join(one("y"), "y").where("not (first_x = last_x and first_y = last_y and first_x = first_y)")  # one component already
    x_is_big = F.col("tokens_x") >= F.col("tokens_y")
    met = met.select(
        F.when(x_is_big, F.col("x")).otherwise(F.col("y")).alias("big"), F.when(x_is_big, F.col("y")).otherwise(F.col("x")).alias("small"), ((F.col("size_x") == 1) & (F.col("size_y") == 1)).alias("alone")
    )
    met = materialize(met, "met")

    near = materialize(grouped.join(met.select(F.col("big").alias("gid")).union(met.select("small")), "gid", "left_semi"), "near")
    tokens = materialize(_tokens(docs, near.select("rep"), like.words), "tokens")
    owned = near.select("rep", "gid", "label")
    alone = met.where("alone").join(owned.select(F.col("gid").alias("big"), F.col("rep").alias("a")), "big").join(owned.select(F.col("gid").alias("small"), F.col("rep").alias("b")), "small").select("a", "b")
    several = met.where("not alone").select("big", "small")
    wanted = owned.join(several.select(F.col("big").alias("gid")).union(several.select("small")), "gid", "left_semi")
    held = wanted.withColumnRenamed("rep", "h").join(_side(tokens, "h"), "h").groupBy("gid").agg(F.collect_list(F.struct("h", "n_h", "label", "of_h")).alias("held"))  # about group_tokens tokens
    each = lambda name: F.transform("held", lambda h: h[name])
    blobs = held.select("gid", each("h").alias("reps"), each("n_h").alias("sizes"), each("label").alias("labels"), F.flatten(each("of_h")).alias("tokens"))
    found = materialize(_links(alone, tokens, like).union(_compare(several, blobs, like)), "links")
    discard(grouped, stats, matrix, met, near, tokens)
    return found


def jaccard_components(docs: DataFrame, like: Similarity = Similarity(), common: int = 1 << 17, common_least: int = 4, group_tokens: int = 1 << 16) -> DataFrame:
    """One row per row of `docs` (doc_id long, text): doc_id, n_shingles, component_id.

    Words are separated by ASCII white space after lower-casing A-Z; a text of fewer words
    than a shingle is one shingle; null and empty texts have none and link with nothing.
    component_id: the smallest doc_id reachable by links. Rows that repeat a doc_id are one
    document with the links of all its rows. A null doc_id is linked with nothing and has a
    null component. An empty table gives no rows; other columns play no part.

    `common`, `common_least`: size of the list of frequent tokens, and in how many texts of
    a batch a token stands to be counted for it; they set the work, never the result.
    `group_tokens`: size of the groups that are opened together, on average.
    """
    spark = docs.sparkSession
    ship_package(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where("doc_id is not null")
    often = spark.sparkContext.broadcast(_common_tokens(known, like.words, common_least, common))
    rows = materialize(_sets(docs, like, often), "sets")
    named = rows.where("n > 0 and doc_id is not null")
    sets = materialize(named.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("core").alias("core"), F.first("keys").alias("keys")), "distinct_sets")

    member = rows.select("doc_id", "n", "set_id").join(sets.select("set_id", "rep"), "set_id", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"))
    member = materialize(member, "members")
    discard(rows)
    # a document whose rows have several sets hangs them together
    several = member.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    same = member.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))

    kin = materialize(_kin(sets), "kin")
    stars = materialize(_stars(kin, like), "stars")
    tokens = materialize(_tokens(docs, stars.select("a").union(stars.select("b")), like.words), "star_tokens")
    links = materialize(_links(stars, tokens, like).union(same), "star_links")
    discard(tokens, stars)
    # groups need no whole components, only sets that surely are of one
    labels = materialize(contracted(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))).groupBy("a").agg(F.min("b").alias("b")), "labels")
    own = F.inline(F.array(*(F.struct(F.col(c).alias("node"), F.col("b").alias("label")) for c in ("a", "b"))))
    nodes = labels.select(own).groupBy("node").agg(F.min("label").alias("label"))
    more = _open_groups(docs, sets, kin, nodes, like, often, group_tokens)
    discard(sets, kin)
    final = connected(links.union(labels).union(more))
    out = member.join(final.withColumnRenamed("node", "rep"), "rep", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "rep")).alias("component_id"))


def deduplicate(docs: DataFrame, like: Similarity = Similarity(), **settings) -> DataFrame:
    """One row of each component of `docs` (doc_id long, text), with all columns: that of the smallest doc_id.

    Of rows that repeat this doc_id, the one with the smallest hash of its text. Rows without
    words or text are components of their own; rows with a null doc_id stay.
    """
    found = jaccard_components(docs, like, **settings)
    found = materialize(found.where("doc_id is not null").select("doc_id", "component_id"), "components")
    kept = without(docs.withColumn("doc_id", F.col("doc_id").cast("long")), found.where("doc_id <> component_id").select("doc_id"), ["doc_id"])
    if not found.groupBy("doc_id").count().where("count > 1").limit(1).count():
        return kept
    one = kept.where("doc_id is not null").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("row")).select("row.*")
    return one.union(kept.where("doc_id is null"))
