"""Small tables with every awkward case, and brute-force versions of the operators."""

import hashlib
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, rep long, label string, hits string, token long, rank int, key string, keep boolean, place long, set_id string"


def docs(spark, rows):
    """(doc_id, text[, lang]) rows with many columns whose names operators may use themselves."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, None if r[1] is None else len(r[1]), 0.5, 7, 1, "x", "h", 3, 2, "k", True, 4, "s") for r in rows]
    return spark.createDataFrame(full, DOCS)


ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER))


def shingles(text, k):
    w = words(text, SPACED)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_components(rows, k, num, den):
    """doc_id -> component, over (doc_id, text) rows; a repeated id has the links of all its rows."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    links = [(a, b) for x, (a, s) in enumerate(sets) for b, t in sets[:x] if a != b and s and t and den * len(s & t) >= num * len(s | t)]
    return components({i for i, _ in sets}, links)


def contamination(text, items):
    w = words(text)
    windows = {}
    for item, t in items:
        v = words(t)
        m = min(13, len(v))
        for i in range(len(v) - m + 1 if v else 0):
            windows.setdefault(tuple(v[i : i + m]), set()).add("" if item is None else str(item))
    hit, found = set(), set()
    for m in {len(x) for x in windows}:
        for i in range(len(w) - m + 1):
            if tuple(w[i : i + m]) in windows:
                hit |= set(range(i, i + m))
                found |= windows[tuple(w[i : i + m])]
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)
