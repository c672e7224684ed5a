from __future__ import annotations

import re

import pytest

from pacewise.llm import urls


def split(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    return ("", "") if not m else (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2])


def rule_of(host, path):
    fits = [
        r for r in urls.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return (best.host + best.path, best.verdict) if best else (None, None)


URLS = [
    "http://WWW.Example.com/en/1", "https://example.com/en/2?x=1", "http://a.example.com/en/3#f",
    "http://example.com/de/", "http://other.com", "http://other.com/", "http://net/es/1",
    "http://x.net/fr/", "http://x.net/frx", "http://xnet/fr/", "no scheme", None, "",
    "a://b://c/d", "http://?q", "http://ÄB.net/es/", "http://x.net\n/es/", "://com/", "http://com/",
    "http://aexample.com/en/", "http://x.net/es/a://b.com/",
]


def test_written_rules(spark):
    rows = [(i, u, "x") for i, u in enumerate(URLS)] + [(0, URLS[0], "x"), (None, URLS[1], "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string")
    got = urls.verdicts(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        url = URLS[1] if r.page_id is None else URLS[r.page_id]
        host, path = split(url)
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule), url
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def test_rules_are_mined_from_labels(spark):
    bad = [(f"http://w{i}.casino-x.org/win/{i}", True) for i in range(30)]
    good = [(f"http://w{i}.news.org/win/{i}?id=1", False) for i in range(60)]
    labels = spark.createDataFrame(bad + good, "url string, blocked boolean")
    pages = spark.createDataFrame(
        [(1, "http://q.casino-x.org/a"), (2, "http://q.news.org/win/7"), (3, "http://casino.org/"),
         (4, "http://z.casino-x.org/en/"), (4, "http://z.casino-x.org/en/")],
        "page_id long, url string",
    )
    got = urls.verdicts(pages, labels=labels, min_support=0.1, min_confidence=0.9).collect()
    assert sorted((r.page_id, r.verdict, r.mined) for r in got) == [
        (1, "block", True), (2, "allow", False), (3, "block", True), (4, "block", True),
        (4, "block", True),
    ]


def test_mined_rules_match_brute_force(spark):
    rows = [
        (["a", "b"], True), (["a", "b", "c"], True), (["a", "c"], False), (["b"], False),
        (["a", "b", "d"], True), (["d"], True), (["d", "c"], True), ([], True),
    ]
    labelled = spark.createDataFrame(rows, "tokens array<string>, blocked boolean")
    found = {tuple(r.tokens): r.confidence for r in urls.mine(labelled, 0.2, 0.9).collect()}
    # d is always blocked; a and b together are, though neither alone is.
    assert found == {("a", "b"): 1.0, ("d",): 1.0}


@pytest.mark.parametrize("rows", [[], [(1, None)]])
def test_nothing_to_judge(spark, rows):
    got = urls.verdicts(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert [(r.host, r.path, r.verdict) for r in got] == [("", "", "allow")] * len(rows)
