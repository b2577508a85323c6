"""Chat formatting: roles of transcript lines by a hidden Markov model, then canonical turns.

States are the roles. A line is observed as its speaker marker, its place (first line of a
row or not) and its length, the first line of a row also by the row's length. There is one
transition table for first lines, one for marked lines and one for all others. All tables
are counted over labelled rows, with prior counts for what the markers mean.

Viterbi's algorithm runs over blocks of turns: each block gives the best score from every
role before it to every role at its end, these matrices are chained (in as many levels as a
conversation's length asks for), and each block is decoded between its two known ends. So a
conversation of any length is decoded exactly, and no task holds more than a block of it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.labels import fold
from shelfcast.llm.textbytes import text_array
from shelfcast.session import materialize, ship_package

ROLES = ("system", "user", "assistant")
#: Speaker markers at the start of a line, in the order of ROLES; any other name with a colon is the last kind.
MARKERS = (r"(?:system|instructions?|context)", r"(?:user|human|customer|client|question|prompter|me|q)", r"(?:assistant|ai|bot|chatbot|gpt|model|agent|answer|a)")
MARKER = r"(?i)^\s*(?:<\|(?:im_start\|>)?|\[|\*\*|#+\s*)?(?:{})(?:\|>|\]|\*\*)?\s*(?::|：|\||\n|$|-\s)\s*"
START, MARKED, PLAIN = 0, 1, 2  # kinds of transitions
KINDS, SIZES = 5, 16  # markers (none, three roles, other) and lengths by powers of two
OBSERVATIONS = 2 * KINDS * SIZES


def _marker(line: Column) -> Column:
    kind = F.when(line.rlike(r"^\s*[A-Z][A-Za-z ]{0,20}:\s"), 4).otherwise(0)
    for i in (2, 1, 0):
        kind = F.when(line.rlike(MARKER.format(MARKERS[i])), i + 1).otherwise(kind)
    return kind


def _size(text: Column) -> Column:
    return F.least(F.floor(F.log2(F.length(text) + 1)).cast("int"), F.lit(SIZES - 1))


def observed_lines(rows: DataFrame) -> DataFrame:
    """row columns, at (line of the row), line, observed, kind of transition."""
    lines = rows.withColumn("size", _size(F.col("text"))).select("*", F.posexplode(F.split("text", "\n")).alias("at", "line"))
    marker = _marker(F.col("line"))
    size = F.when(F.col("at") == 0, F.col("size")).otherwise(_size(F.col("line")))
    first = (F.col("at") == 0).cast("int")
    lines = lines.withColumns({"marker": marker, "seen": size})
    return lines.withColumns({"observed": (first * KINDS + F.col("marker")) * SIZES + F.col("seen"), "kind": F.when(F.col("at") == 0, START).when(F.col("marker") > 0, MARKED).otherwise(PLAIN)}).drop("size", "seen")


@dataclass
class Model:
    start: np.ndarray  # log probabilities: role
    moves: np.ndarray  # kind of transition, role before, role
    emits: np.ndarray  # role, observation


def learn(rows: DataFrame) -> Model:
    """Counts over labelled rows (conv, turn, text, role in ROLES) with priors: tables of fixed size."""
    index = F.array_position(F.array(*map(F.lit, ROLES)), F.col("role")).cast("int") - 1
    rows = rows.where(F.col("role").isin(*ROLES)).withColumn("state", index)
    emits = np.zeros((3, OBSERVATIONS))
    for state, observed, n in observed_lines(rows).groupBy("state", "observed").count().collect():
        emits[state, observed] += n
    emits = emits / np.maximum(emits.sum(axis=1, keepdims=True), 1)
    floor = np.full(emits.shape, 1e-3 / OBSERVATIONS)
    for role in range(3):  # a marker means its role, whatever the sizes
        for place in range(2):
            for kind in (1, 2, 3):
                cells = slice((place * KINDS + kind) * SIZES, (place * KINDS + kind + 1) * SIZES)
                floor[role, cells] = (0.05 if kind == role + 1 else 1e-6) / SIZES
    emits += floor
    states = rows.select("conv", "turn", "state")
    first = states.join(states.groupBy("conv").agg(F.min("turn").alias("turn")), ["conv", "turn"])
    start = np.ones(3)
    for state, n in first.groupBy("state").count().collect():
        start[state] += n
    moves = np.ones((3, 3, 3))
    after = states.select("conv", (F.col("turn") - 1).alias("turn"), F.col("state").alias("next"))
    for state, following, n in states.join(after, ["conv", "turn"]).groupBy("state", "next").count().collect():
        moves[START, state, following] += n
    moves[PLAIN] += 1e6 * np.eye(3)  # without a marker the speaker goes on
    logs = lambda x: np.log(x / x.sum(axis=-1, keepdims=True))
    return Model(logs(start), logs(moves), logs(emits))


def through(model: Model, observed: list[int], kinds: list[int]) -> np.ndarray:
    """Best score from each role before (the fourth: none, a start) to each role at the end."""
    scores = None
    for o, k in zip(observed, kinds, strict=True):
        if scores is None:
            scores = np.concatenate([model.moves[k], model.start[None]]) + model.emits[:, o]
        else:
            scores = (scores[:, :, None] + model.moves[k][None]).max(axis=1) + model.emits[:, o]
    return scores


def decode(model: Model, observed: list[int], kinds: list[int], before: int, end: int) -> list[int]:
    """The best roles of a block between the role before it (3: none) and its last role."""
    back, score = [], None
    for o, k in zip(observed, kinds, strict=True):
        if score is None:
            score = (model.start if before == 3 else model.moves[k][before]) + model.emits[:, o]
        else:
            paths = score[:, None] + model.moves[k]
            back.append(paths.argmax(axis=0))
            score = paths.max(axis=0) + model.emits[:, o]
    path = [end]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def chain(matrices: list[np.ndarray], before: int, end: int | None) -> list[int]:
    """The roles at the ends of blocks in sequence, from their matrices."""
    score, back = matrices[0][before], []
    for m in matrices[1:]:
        paths = score[:, None] + m[:3]
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0)
    path = [int(score.argmax()) if end is None else end]
    for b in reversed(back):
        path.append(int(b[path[-1]]))
    return path[::-1]


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, list[dict]]]:
    """Consecutive rows with equal keys, also across batches."""
    rows = (r for b in batches for r in b.to_pylist())
    for key, group in groupby(rows, key=lambda r: tuple(r[k] for k in keys)):
        yield key, list(group)


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    part = []
    for r in rows:
        part.append(r)
        if len(part) == size:
            yield pa.RecordBatch.from_pylist(part, schema)
            part = []
    yield pa.RecordBatch.from_pylist(part, schema)


def _dealt(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


_MATRIX = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("matrix", pa.list_(pa.float64()))])
_ENDS = pa.schema([("conv", pa.string()), ("block", pa.int64()), ("before", pa.int64()), ("end", pa.int64())])


def _chained(matrices: DataFrame, fan: int) -> DataFrame:
    """Role before and at the end of every block."""
    levels = [materialize(matrices, "blocks")]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) >= fan:

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows():
                for (conv, up), group in _groups(batches, ("conv", "up")):
                    m = np.reshape(group[0]["matrix"], (4, 3))
                    for r in group[1:]:
                        m = (m[:, :, None] + np.reshape(r["matrix"], (4, 3))[None, :3]).max(axis=1)
                    yield {"conv": conv, "block": up, "matrix": m.ravel().tolist()}

            yield from _batches(rows(), _MATRIX)

        up = levels[-1].withColumn("up", F.floor(F.col("block") / fan))
        levels.append(materialize(_dealt(up, ["conv", "up"], ["block"]).mapInArrow(product, "conv string, block long, matrix array<double>"), "blocks"))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for (conv, _), group in _groups(batches, ("conv", "up")):
                last = group[0]["before"]
                ends = chain([np.reshape(r["matrix"], (4, 3)) for r in group], last, group[0]["end"])
                for r, end in zip(group, ends, strict=True):
                    yield {"conv": conv, "block": r["block"], "before": last, "end": end}
                    last = end

        yield from _batches(rows(), _ENDS)

    known = None
    for level in reversed(levels):
        blocks = level.withColumn("up", F.floor(F.col("block") / fan))
        if known is None:
            blocks = blocks.withColumns({"before": F.lit(3).cast("long"), "end": F.lit(None).cast("long")})
        else:
            blocks = blocks.join(known.withColumnRenamed("block", "up"), ["conv", "up"])
        known = _dealt(blocks, ["conv", "up"], ["block"]).mapInArrow(solve, "conv string, block long, before long, end long")
    return known


def format_chats(transcripts: DataFrame, training: DataFrame, turns: int = 256, fan: int = 1024) -> DataFrame:
    """Recover roles and render `transcripts` (conv_id, turn, text), learning from `training` (with role).

    One row per run of lines of one role in a row: conv_id, turn, part (from 0), role, text
    (without speaker markers), n_lines, rendered. The `rendered` texts of a conversation, in
    order, are its canonical form: `<|role|>` and a line end where the role changes.

    Given roles of `transcripts` are not read. Null and empty texts are one empty line. Rows
    that repeat entirely count once; rows of one turn are ordered by text. A null conv_id or
    turn makes its row a conversation of its own. Other columns play no part; an empty table
    gives no rows; without training rows only the markers decide. `turns`, `fan`: size of the
    blocks, they don't change results.
    """
    spark = transcripts.sparkSession
    ship_package(spark)
    keyed = lambda df: F.when(F.col("conv_id").isNotNull() & F.col("turn").isNotNull(), F.concat(F.lit("c"), F.col("conv_id").cast("string"))).otherwise(F.concat(F.lit("r"), F.sha2(F.concat_ws("\x00", F.coalesce(F.col("conv_id").cast("string"), F.lit("-")), F.coalesce(F.col("turn").cast("string"), F.lit("-")), "text"), 256)))
    text = F.coalesce("text", F.lit("")).alias("text")
    rows = transcripts.select("conv_id", "turn", text).distinct().withColumn("conv", keyed(None))
    labelled = training.select("conv_id", F.col("turn").cast("long").alias("turn"), text, "role").where("conv_id is not null and turn is not null").withColumn("conv", F.col("conv_id").cast("string"))
    shared = spark.sparkContext.broadcast(learn(labelled))

    least = rows.groupBy("conv").agg(F.min("turn").alias("least"))  # blocks count from a conversation's first turn
    placed = rows.join(least, "conv").withColumn("block", F.coalesce(F.floor((F.col("turn") - F.col("least")) / turns), F.lit(0)).cast("long")).drop("least")
    lines = observed_lines(placed)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found():
            for (conv, block), group in _groups(batches, ("conv", "block")):
                m = through(shared.value, [r["observed"] for r in group], [r["kind"] for r in group])
                yield {"conv": conv, "block": block, "matrix": m.ravel().tolist()}

        yield from _batches(found(), _MATRIX)

    seen = lines.select("conv", "block", "turn", F.xxhash64("text").alias("tie"), "at", "observed", "kind")
    order = ["turn", "tie", "at"]
    ends = _chained(_dealt(seen, ["conv", "block"], order).mapInArrow(matrices, "conv string, block long, matrix array<double>"), fan)
    types = dict(transcripts.dtypes)
    schema = f"conv_id {types['conv_id']}, turn {types['turn']}, part long, role string, text string, n_lines long, rendered string"
    columns = ("conv_id", "turn", "part", "role", "text", "n_lines", "rendered")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for _, group in _groups(batches, ("conv", "block")):
            before = group[0]["before"]
            path = decode(shared.value, [r["observed"] for r in group], [r["kind"] for r in group], before, group[0]["end"])
            part, last = 0, before
            for (turn, _), own in groupby(zip(group, path, strict=True), key=lambda x: ((x[0]["turn"], x[0]["tie"]), 0)):
                part = 0
                for state, run in groupby(own, key=lambda x: x[1]):
                    some = [r for r, _ in run]
                    said = "\n".join(r["line"] for r in some)
                    head = "" if state == last else ("" if last == 3 else "\n") + f"<|{ROLES[state]}|>\n"
                    parts.append((some[0]["conv_id"], turn[0], part, ROLES[state], said, len(some), (head or "\n") + said))
                    part, last = part + 1, state
            if len(parts) >= 2000:
                yield _record(parts)
                parts = []
        yield _record(parts)

    id_type, turn_type = (f.type for f in (transcripts.select("conv_id", "turn").limit(0).toArrow().schema))
    arrow = pa.schema([("conv_id", id_type), ("turn", turn_type), ("part", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("n_lines", pa.int64()), ("rendered", pa.string())])

    def _record(parts: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in parts], arrow.field(i).type) for i in range(len(columns))], names=list(columns))

    bare = F.col("line")
    for pattern in MARKERS:
        bare = F.when(F.col("line").rlike(MARKER.format(pattern)), F.regexp_replace("line", MARKER.format(pattern), "")).otherwise(bare)
    full = lines.select("conv", "block", "conv_id", "turn", F.xxhash64("text").alias("tie"), "at", "observed", "kind", F.when(F.col("marker") > 0, bare).otherwise(F.col("line")).alias("line"))
    return _dealt(full.join(ends, ["conv", "block"]), ["conv", "block"], order).mapInArrow(decoded, schema)


def held_out(conv_id: str = "conv_id") -> Column:
    """Every fifth conversation, by checksum, is kept from training."""
    return F.coalesce(fold(conv_id, 5) == 0, F.lit(False))
