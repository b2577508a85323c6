"""Toxicity by a weighted lexicon, found with an Aho-Corasick automaton in folded text.

Folding lower-cases, maps look-alike letters of other scripts and digits or signs that stand
for letters, and joins the letters l and i (both are written 1). Lexicon terms are whole
words or word beginnings. They are learned from labelled documents: terms that are much more
frequent in toxic ones, chosen greedily until the toxic documents are covered several times,
weighted by their log odds. Phrases around a term that only clean documents have are
exceptions. The weights of a document's terms, divided by its length, go through a logistic
curve fitted on the same sample. Near copies of a text are one document in all these counts:
a text that was copied a thousand times says as much about its words as one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import exp, log, log1p
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.labels import fold, labelled_sample
from shelfcast.llm.textbytes import shingle_sets, slices, text_array
from shelfcast.session import materialize, ship_package

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("аеорсухіјѕԁдһгвнкмтοαρνιτκυε", "aeopcyxijsddhrbhkmtoapvitkue", strict=True))
#: Digits and signs written for letters; l joins i, as 1 stands for both.
SIGNS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "l": "i"}
FULL_WIDTH = {chr(0xFF01 + k): chr(0x21 + k).lower() for k in range(94)}
ASCII_FOLD = str.maketrans({**SIGNS, **{chr(65 + k): SIGNS.get(chr(97 + k), chr(97 + k)) for k in range(26)}})
WIDE = re.compile("[" + "".join(HOMOGLYPHS) + "".join(h.upper() for h in HOMOGLYPHS) + "！-～​-‍­]")
WIDE_FOLD = str.maketrans({**HOMOGLYPHS, **{h.upper(): c for h, c in HOMOGLYPHS.items()}, **FULL_WIDTH, **dict.fromkeys("​‌‍­", "")})
WORD = re.compile(r"[^\W\d_]+")
#: A sign in front of no letter is punctuation, not a letter.
LOOSE = re.compile(r"[@$]+(?![^\W_])")


def fold_text(text: str) -> str:
    if WIDE.search(text):
        text = text.translate(WIDE_FOLD)
    text = text.lower()
    if "$" in text or "@" in text:
        text = LOOSE.sub(" ", text)
    return text.translate(ASCII_FOLD)


@dataclass
class Lexicon:
    weights: dict[str, float]  # terms: "^word$" or "^beginning"
    exceptions: set[tuple[str, str]]  # neighbouring words of which the term's weight doesn't count
    slope: float = 1.0
    offset: float = 0.0

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term in self.weights:
            found.add_word(term.strip("^$"), term.strip("^$"))
        if self.weights:
            found.make_automaton()
        return found

    def matches(self, text: str, automaton) -> list[tuple[int, str]]:
        """(place, term) in folded text: the heaviest term for each word beginning."""
        best: dict[int, str] = {}
        if not self.weights:
            return []
        for end, body in automaton.iter(text):
            start = end - len(body) + 1
            if start and text[start - 1].isalpha():
                continue
            whole = end + 1 == len(text) or not text[end + 1].isalpha()
            for term in (f"^{body}$",) * whole + (f"^{body}",):
                if term in self.weights and self.weights[term] > self.weights.get(best.get(start, ""), 0.0):
                    best[start] = term
        return sorted(best.items())

    def density(self, text: str, automaton) -> float:
        """Weight of the matched terms for every hundred words of folded text."""
        found = self.matches(text, automaton)
        if not found:
            return 0.0
        if self.exceptions:
            found = [(at, term) for at, term in found if not self._excepted(text, at)]
        words = len(text.split())
        return 100.0 * sum(self.weights[term] for _, term in found) / max(words, 1)

    def _excepted(self, text: str, at: int) -> bool:
        word = WORD.match(text, at)[0]
        before = re.search(r"([^\W\d_]+)[\s-]+$", text[max(0, at - 60) : at])
        after = re.match(r"[\s-]+([^\W\d_]+)", text[at + len(word) : at + len(word) + 60])
        return bool((before and (before[1], word) in self.exceptions) or (after and (word, after[1]) in self.exceptions))

    def score(self, density: float) -> float:
        return 1.0 / (1.0 + exp(-max(-30.0, min(30.0, self.slope * log1p(density) + self.offset))))


def _terms(words: set[str], shortest: int, longest: int) -> set[str]:
    out = {f"^{w}$" for w in words if len(w) >= 3}
    for w in words:
        out.update(f"^{w[:k]}" for k in range(shortest, min(longest, len(w)) + 1))
    return out


def families(texts: list[str], most: int = 256) -> list[list[int]]:
    """Places of the texts by family: a text and the others that share over half of its three-word runs.

    Similarity is Jaccard's, exact for texts of up to `most` runs, else of the `most` smallest
    hashes of each. A text without words is a family of its own.
    """
    sketches = [runs[:most] for runs in shingle_sets(pa.array(texts, pa.large_string()), 3)]
    sizes = np.array([len(s) for s in sketches], np.int64)
    values, owner = np.concatenate([np.zeros(0, np.uint64), *sketches]), np.repeat(np.arange(len(texts)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    out, left = [], np.ones(len(texts), bool)
    for i, own in enumerate(sketches):
        if left[i]:
            low, high = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            size = high - low
            shared = np.bincount(owner[np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low, size)], minlength=len(texts))
            near = left & (3 * shared > sizes + len(own))
            near[i] = True
            left &= ~near
            out.append(np.flatnonzero(near).tolist())
    return out


def learn(rows: list[tuple[str, int]], exceptions: tuple[tuple[str, str], ...] = (), most: int = 256, times: int = 8, shortest: int = 4, longest: int = 7) -> Lexicon:
    """The lexicon of a sample of (text, label). Without documents of both classes it is empty."""
    folded = [(fold_text(t), y) for t, y in rows]
    # near copies are one document: a family of places in `folded`
    toxic, clean = ([[at[k] for k in f] for f in families([folded[i][0] for i in at])] for at in ([i for i, r in enumerate(folded) if bool(r[1]) == y] for y in (True, False)))
    lexicon = Lexicon({}, {tuple(fold_text(w) for w in e) for e in exceptions}, offset=-2.0)
    if not toxic or not clean:
        return lexicon
    least = max(3, len(toxic) // 200)
    terms_of = lambda family: set().union(*(_terms(set(WORD.findall(folded[i][0])), shortest, longest) for i in family))
    # counts by hash first (too large at most): rare terms, nearly all, are never held
    cells = np.zeros(1 << 22, np.uint32)
    for family in toxic:
        cells[np.unique([crc32(t.encode()) & (1 << 22) - 1 for t in terms_of(family)]).astype(np.int64)] += 1
    in_toxic: dict[str, list[int]] = {}
    for k, family in enumerate(toxic):
        for term in terms_of(family):
            if cells[crc32(term.encode()) & (1 << 22) - 1] >= least:
                in_toxic.setdefault(term, []).append(k)
    in_toxic = {t: at for t, at in in_toxic.items() if len(at) >= least}
    in_clean = dict.fromkeys(in_toxic, 0)
    for family in clean:
        for term in terms_of(family) & in_clean.keys():
            in_clean[term] += 1
    odds = {t: log((len(at) + 0.5) / (len(toxic) + 1)) - log((in_clean[t] + 0.5) / (len(clean) + 1)) for t, at in in_toxic.items()}
    odds = {t: w for t, w in odds.items() if w >= 3.5}
    if not odds:
        return lexicon

    # greedy cover: always the term that adds most to the documents not yet covered `times` times
    terms = sorted(odds, key=lambda t: (-odds[t] * len(in_toxic[t]), t[-1] != "$", -len(t), t))[: 16 * most]
    stands = np.zeros((len(terms), len(toxic)), np.float32)
    for k, term in enumerate(terms):
        stands[k, in_toxic[term]] = 1
    weight, covered, open_ = np.array([odds[t] for t in terms]), np.zeros(len(toxic)), np.ones(len(terms), bool)
    chosen: list[int] = []
    while open_.any() and len(lexicon.weights) < most:
        adds = stands @ (covered < times).astype(np.float32)
        best = int(np.argmax(np.where(open_, weight * adds, -1)))
        if adds[best] < least:
            break
        open_[best] = False
        body = terms[best].strip("^$")
        related = [k for k in chosen if terms[k].strip("^$").startswith(body) or body.startswith(terms[k].strip("^$"))]
        fresh = stands[best] * (stands[related].max(axis=0) == 0) if related else stands[best]
        if fresh.sum() < least:
            continue  # says the same as a chosen term
        chosen.append(best)
        lexicon.weights[terms[best]] = odds[terms[best]]
        covered += fresh

    automaton = lexicon.automaton()
    phrases: dict[tuple[str, str], list[int]] = {}
    weight = np.zeros(len(folded))
    for y, side in enumerate((clean, toxic)):
        for family in side:
            weight[family] = 0.5 / len(side) / len(family)
            around = set()
            for text in (folded[i][0] for i in family):
                for at, _ in lexicon.matches(text, automaton):
                    word = WORD.match(text, at)[0]
                    before = re.search(r"([^\W\d_]+)[\s-]+$", text[max(0, at - 60) : at])
                    after = re.match(r"[\s-]+([^\W\d_]+)", text[at + len(word) : at + len(word) + 60])
                    around |= {(before[1], word) if before else None, (word, after[1]) if after else None} - {None}
            for phrase in around:
                phrases.setdefault(phrase, [0, 0])[y] += 1
    lexicon.exceptions |= {p for p, (n, bad) in phrases.items() if n >= 3 and not bad}

    x = np.array([log1p(lexicon.density(t, automaton)) for t, _ in folded])
    y = np.array([label for _, label in folded], float)
    slope, offset = 1.0, -2.0
    for _ in range(50):  # Newton's method for the logistic curve, with a small ridge
        p = 1 / (1 + np.exp(-(slope * x + offset)))
        g = np.array([(weight * (p - y) * x).sum() + 1e-3 * slope, (weight * (p - y)).sum() + 1e-4 * offset])
        v = weight * p * (1 - p)
        h = np.array([[(v * x * x).sum() + 1e-3, (v * x).sum()], [(v * x).sum(), v.sum() + 1e-4]])
        step = np.linalg.solve(h, g)
        slope, offset = slope - step[0], offset - step[1]
        if np.abs(step).max() < 1e-8:
            break
    lexicon.slope, lexicon.offset = float(max(slope, 0.0)), float(offset)
    return lexicon


def lexicon_of(docs: DataFrame, labels: DataFrame, folds: int, held: int, per_class: int, exceptions: tuple[tuple[str, str], ...] = ()) -> Lexicon:
    """Learned from up to `per_class` documents of either class, without the held fold."""
    sample = labelled_sample(docs, labels, "toxic", fold("doc_id", folds) != held, per_class)
    rows = sorted((r["doc_id"], r["text"], r["label"]) for r in materialize(sample, "toxic_sample").toLocalIterator())
    return learn([(t, y) for _, t, y in rows], exceptions)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, per_class: int = 2000, exceptions: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """doc_id, score (0 to 1) and density for every row of `docs` (doc_id, text).

    The lexicon is learned from up to `per_class` documents of either class of `labels`
    (doc_id, toxic), without those whose crc32(doc_id) modulo `folds` is `held`, near copies
    counted once; every whole text is scored. Null and empty texts have density 0. Without labels of both classes all
    scores are the same low value. Rows that repeat are scored each for itself, a null doc_id
    stays null, other columns play no part, an empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon_of(docs, labels, folds, held, per_class, exceptions))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        automaton = lexicon.automaton()
        for batch in batches:
            density = [lexicon.density(fold_text(t.as_py() or ""), automaton) for t in text_array(batch, "text")]
            yield pa.RecordBatch.from_arrays([text_array(batch, "doc_id"), pa.array([lexicon.score(d) for d in density], pa.float64()), pa.array(density, pa.float64())], names=["doc_id", "score", "density"])

    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {dict(docs.dtypes)['doc_id']}, score double, density double")


def reject_toxic(docs: DataFrame, labels: DataFrame, limit: float = 0.7, folds: int = 3, held: int = 1, per_class: int = 2000, exceptions: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """The rows of `docs` (doc_id, text), with all columns, that `toxicity` scores below `limit`.

    Each row is judged for itself, also one that repeats or has a null doc_id. A null text is
    empty, an empty one stays. Without labels of both kinds the lexicon is empty and all rows stay.
    """
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon_of(docs, labels, folds, held, per_class, exceptions))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = shared.value
        automaton = lexicon.automaton()
        for batch in slices(batches):
            keep = [lexicon.score(lexicon.density(fold_text(t.as_py() or ""), automaton)) < limit for t in text_array(batch, "text")]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(work, docs.schema)
