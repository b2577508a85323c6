"""Secret scans: patterns for known kinds, and sliding-window entropy for strings of no known kind.

A candidate is a maximal run of one character class. A window slides over it and keeps the
characters' counts; the sum of count * log2(count), from which Shannon's entropy follows,
changes by two terms a step. Runs of windows above the class's threshold are spans, unless
the string is on the allow list or lies inside a pattern's span.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from math import log2

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.textbytes import slices, text_array
from shelfcast.session import ship_package

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs of which shorter ones fail
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class CharClass:
    """Candidates, window and least entropy in bits of one character class."""

    kind: str
    candidate: re.Pattern
    window: int
    bits: float


CLASSES = (
    CharClass("entropy_hex", re.compile(r"(?<![A-Za-z0-9])(?:[0-9a-f]{20,}|[0-9A-F]{20,})(?![A-Za-z0-9])"), 20, 3.0),
    CharClass("entropy_base64", re.compile(r"[A-Za-z0-9+/_=-]{24,}"), 24, 3.9),
)
KINDS = (*BASE_KINDS, *(c.kind for c in CLASSES))

#: Strings that are no secrets: without a digit or without a letter, identifiers and dates made
#: of short parts, universally unique ids, paths of plain words.
ALLOW = (
    r"[^0-9]*",
    r"[^A-Za-z]*",
    r"(?:[A-Za-z]+|[0-9]+)(?:[-_/=+]+(?:[A-Za-z]+|[0-9]+))*[-_/=+]*",
    r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}",
)
#: A part of a string, between separators, in which one of these stands is a sample or a placeholder; other parts are scanned.
PLACEHOLDER = re.compile(r"example|sample|dummy|placeholder|x{6,}|0123456789|abcdef0?123", re.IGNORECASE)
PART = re.compile(r"[^/+=_-]+")


def entropy_spans(text: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Merged spans of `text` covered by windows of at least `bits` bits of entropy."""
    if len(text) < window:
        return []
    weight = [0.0, *(c * log2(c) for c in range(1, window + 1))]
    counts: dict[str, int] = {}
    total, spans = 0.0, []
    most = window * (log2(window) - bits) + 1e-9  # entropy = log2(window) - total / window
    for i, char in enumerate(text):
        n = counts.get(char, 0)
        total += weight[n + 1] - weight[n]
        counts[char] = n + 1
        if i >= window:
            n = counts[text[i - window]]
            total += weight[n - 1] - weight[n]
            counts[text[i - window]] = n - 1
        if i >= window - 1 and total <= most:
            if spans and spans[-1][1] >= i - window + 1:
                spans[-1] = (spans[-1][0], i + 1)
            else:
                spans.append((i - window + 1, i + 1))
    return spans


def _within(spans: list[tuple[int, int, str]]):
    """Whether a range lies in one of the spans: the furthest end of those that start before it decides."""
    starts = sorted(s[:2] for s in spans)
    ends = list(accumulate((e for _, e in starts), max))
    starts = [a for a, _ in starts]
    return lambda a, b: (k := bisect_right(starts, a)) > 0 and ends[k - 1] >= b


def _without_placeholders(start: int, run: str) -> Iterator[tuple[int, str]]:
    """The pieces of a run, and where they start, that its parts with placeholders leave."""
    if not PLACEHOLDER.search(run):
        yield start, run
        return
    begin = 0
    for part in PART.finditer(run):
        if PLACEHOLDER.search(part[0]):
            yield start + begin, run[begin : part.start()]
            begin = part.end()
    yield start + begin, run[begin:]


def find_spans(text: str, allow: re.Pattern, classes: tuple[CharClass, ...] = CLASSES) -> list[tuple[int, int, str]]:
    """(start, end, kind) in code points, by start and then by kind as listed."""
    found = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for c in classes:
        inside = _within(found)  # those of one class lie apart
        for m in c.candidate.finditer(text):
            for at, run in _without_placeholders(m.start(), m[0]):
                if len(run) < c.window or allow.fullmatch(run) or inside(at, at + len(run)):
                    continue
                for a, b in entropy_spans(run, c.window, c.bits):
                    if not allow.fullmatch(run[a:b]) and not inside(at + a, at + b):
                        found.append((at + a, at + b, c.kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def compiled(allow: tuple[str, ...]) -> re.Pattern:
    return re.compile("|".join(f"(?:{a})" for a in allow) or r"(?!)", re.DOTALL)


def scan(docs: DataFrame, allow: tuple[str, ...] = ALLOW) -> DataFrame:
    """doc_id and secret_spans, an array of (kind, start, end), for every row of `docs` (doc_id, text).

    Offsets are code points, the end is exclusive. Null and empty texts have no spans; rows
    that repeat are scanned each for itself; other columns play no part. An empty table
    gives no rows.
    """
    ship_package(docs.sparkSession)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = compiled(allow)
        for batch in batches:
            rows = [[{"kind": k, "start": a, "end": b} for a, b, k in find_spans(text.as_py() or "", allowed)] for text in text_array(batch, "text")]
            yield pa.RecordBatch.from_arrays([text_array(batch, "doc_id"), pa.array(rows, kind)], names=["doc_id", "secret_spans"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, secret_spans array<struct<kind:string,start:bigint,end:bigint>>")


def redact_text(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Every span (overlapping ones as one) replaced by its first kind in brackets."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[at:start], f"[{kind}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, allow: tuple[str, ...] = ALLOW, length: str | None = None) -> DataFrame:
    """`docs` with every secret in `text` replaced by its kind in brackets.

    All rows and columns stay, also null texts and texts without a secret, unchanged.
    `length`: a column that has the text's number of characters and is kept up to date.
    """
    ship_package(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = compiled(allow)
        for batch in slices(batches):
            texts = text_array(batch, "text").to_pylist()
            found = [find_spans(t or "", allowed) for t in texts]
            new = {"text": [redact_text(t, f) if f else t for t, f in zip(texts, found, strict=True)]}
            if length:
                new[length] = [len(t) if f else n for t, f, n in zip(new["text"], found, text_array(batch, length).to_pylist(), strict=True)]
            for name, values in new.items():
                field = batch.schema.field(name)
                batch = batch.set_column(batch.schema.get_field_index(name), field, pa.array(values, field.type))
            yield batch

    return docs.mapInArrow(work, docs.schema)


def digest(spans: DataFrame) -> DataFrame:
    """Counts and digests of `scan`'s rows: doc_id, n_assign, n_access, n_hex, n_added, base_sha256, spans."""
    count = lambda kinds: F.size(F.filter("secret_spans", lambda s: s["kind"].isin(*kinds))).cast("long")
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("secret_spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return spans.select("doc_id", *(count([k]).alias(f"n_{k}") for k in BASE_KINDS), count([c.kind for c in CLASSES]).alias("n_added"), F.sha2(joined(base), 256).alias("base_sha256"), joined("secret_spans").alias("spans"))
