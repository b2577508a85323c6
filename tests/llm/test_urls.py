import itertools
from math import log

import pytest

from shelfcast.llm.labels import most_frequent
from shelfcast.llm.urls import RULES, Segmenter, judge

URLS = [
    "http://www.Example.ORG/es/1", "https://example.org/en/1?x=/es/", "http://a.b.example.org/en/2", "http://com/fr/", "http://x.com/fr", "http://x.com/de/4#a", "http://notorg/", "http://org", "http://org/", "x://y://example.org/es/",
    "no scheme.com/fr/", "", None, "http://", "://", "http://example.org:80/es/", "http://badexample.org/es/1", "ftp://x.net?org/", "http://é.org/ü", "http://x.com/de/4", "http://x.com/de/4",
]


def parse(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:end], rest[end:]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[: min((rest.index(c) for c in "?#" if c in rest), default=len(rest))]


def rule(host, path):
    fits = [(len(r), r, v) for v, r in RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits)[1:] if fits else (None, None)


def pages(spark, urls):
    return spark.createDataFrame([(None if k == 3 else k, u, "<p>cheap pills <b>blog</b> pills" if k % 2 else None, "x", 1.0) for k, u in enumerate(urls)], "page_id long, url string, html string, rule string, score double")


def test_rules_and_parts_against_brute_force(spark):
    rows = judge(pages(spark, URLS)).collect()
    assert len(rows) == len(URLS)
    want = sorted((str(None if k == 3 else k), *parse(u), str(rule(*parse(u))[0])) for k, u in enumerate(URLS))
    assert sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"])) for r in rows) == want
    for r in rows:
        if r["rule"]:
            assert r["verdict"] == rule(r["host"], r["path"])[1]
    assert {r["verdict"] for r in rows} == {"allow", "block"}
    assert judge(pages(spark, [])).count() == 0
    assert {r["verdict"] for r in judge(pages(spark, ["http://a.net/x", None])).collect()} == {"allow"}


def test_naive_bayes_follows_the_rules_words(spark):
    urls = [f"http://good{k}.x.org/news/{k}" for k in range(30)] + [f"http://shop{k}.com/de/cheappills/{k}" for k in range(30)] + ["http://a.net/cheappills/9", "http://a.net/news/9"]
    rows = {r["page_id"]: r for r in judge(pages(spark, urls)).collect()}
    assert rows[60]["verdict"] == "block" and "p:cheap p:pills" in rows[60]["words"] and rows[61]["verdict"] == "allow"


def test_rare_words_of_large_tables_count(spark):
    letters = "bcdfghjklmnpqrst"
    others = " ".join("x" + "".join(letters[k >> 4 * j & 15] for j in range(5)) + "x" for k in range(70000))
    urls = ["http://a.net/zebraquilt/9/zebraquilt", "http://zebraquilt.net/é", "http://a.net/zebraquilt/9/zebraquilt"]
    frame = spark.createDataFrame([(k, u, f"{others} zebra quilt" if k == 1 else None) for k, u in enumerate(urls)], "page_id long, url string, html string")
    found = {r["page_id"]: r["words"] for r in judge(frame).collect()}
    assert found == {0: "h:a h:net p:zebra p:quilt p:#1 p:zebra p:quilt", 1: "h:zebra h:quilt h:net p:é", 2: found[0]}
    odd = {r["page_id"]: r["words"] for r in judge(pages(spark, ["http://a.net/a b/**/ü²/²", None])).collect()}
    assert odd[0] == "h:a h:net p:a p:  p:b p:** p:ü² p:#1"


@pytest.mark.parametrize("name", ["cheappills", "blogpills", "zzzq", "cheapzpills", "a", ""])
def test_segmentation_against_every_split(name):
    s = Segmenter({"cheap": 5, "pills": 7, "blog": 3, "ch": 1, "ills": 2})
    cost = lambda w: s.logs.get(w, s.unknown[len(w)])
    splits = []
    for cuts in itertools.product([0, 1], repeat=max(0, len(name) - 1)):
        at = [0, *(i + 1 for i, c in enumerate(cuts) if c), len(name)]
        splits.append([name[a:b] for a, b in itertools.pairwise(at) if a < b])
    best = max(sum(map(cost, x)) for x in splits)
    assert abs(sum(map(cost, s.split(name))) - best) < 1e-9 and "".join(s.split(name)) == name and log(5 / 19) == s.logs["cheap"]


def test_most_frequent_values_within_a_bound(spark):
    rows = [(f"a{k}", n) for n, many in ((1, 50), (2, 20), (7, 5), (100, 3)) for k in range(many)]
    frame = spark.createDataFrame(rows, "word string, n long")
    assert [most_frequent(frame, m).count() for m in (100, 78, 77, 28, 27, 8, 3, 2)] == [78, 78, 28, 28, 8, 8, 3, 0]


def test_names_of_any_length(spark):
    long = "cheappills" * 10000  # 100,000 letters
    rows = {r["page_id"]: r for r in judge(pages(spark, [f"http://a.net/{long}", f"http://{long}.net/x", "http://a.net/cheappills", None])).collect()}
    assert rows[0]["words"].split() == ["h:a", "h:net"] + ["p:cheap", "p:pills"] * 10000
    assert rows[1]["words"].split() == ["h:cheap", "h:pills"] * 10000 + ["h:net", "p:x"]
    assert rows[1]["host"] == f"{long}.net" and rows[2]["words"] == "h:a h:net p:cheap p:pills"
