import re

import pytest

import compare
from lectern.llm import urls
from lectern.llm.queries import HOST_RULES


def test_equals_sql_that_runs_every_pattern(spark):
    sf = "/root/testdata/sf0.01"
    query = lambda s, d: urls.judge(s.read.parquet(f"{d}/pages.parquet"), HOST_RULES)
    assert compare.difference(spark, compare.connect(sf), sf, query, urls.judge_sql(HOST_RULES)) is None


CASES = [
    ("http://a.net/x", "a.net", "/x", "net/", "block"),
    ("http://NET/", "net", "/", "net/", "block"),
    ("http://a.net", "a.net", "", None, "allow"),
    ("http://b.example.net/en/1?q", "b.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://anexample.net/en/1", "anexample.net", "/en/1", "net/", "block"),
    ("http://example.com/de/1", "example.com", "/de/1", "example.com/de/", "block"),
    ("http://x.org/fr/#a", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://q.org?u=http://b.net/", "q.org", "", None, "allow"),
    ("http://Casino.example.ORG/p", "casino.example.org", "/p", None, "block"),
    ("http://x.example.org/casino.html", "x.example.org", "/casino.html", None, "allow"),
    ("http://docs.x.org/malware.html", "docs.x.org", "/malware.html", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://x.org/" + "a" * 100000 + "/download-x-crack", "x.org", "/" + "a" * 100000 + "/download-x-crack", None, "block"),
]


def test_cases(spark):
    rows = [(i, c[0], "h", "x") for i, c in enumerate(CASES)]
    pages = spark.createDataFrame(rows + rows[:2], "page_id long, url string, html string, rule string")
    found = urls.judge(pages, HOST_RULES)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
    expected = [(i, *c[1:]) for i, c in enumerate(CASES)]
    assert sorted(tuple(r)[:5] for r in found.collect()) == sorted(expected + expected[:2])
    assert urls.judge(pages.where("false"), HOST_RULES).count() == 0


def test_tokens_stand_in_every_match():
    matching = {
        "||casino-*.com^": "http://x.casino-777.com/",
        "^affiliate_id=": "http://a.b/?affiliate_id=3",
        "/banner/ads/": "http://a.b/banner/ads/1",
        ".exe|": "http://a.b/c.exe",
    }
    for pattern, url in matching.items():
        assert re.search(urls.regex(pattern), url)
        assert set(urls.tokens_of(pattern)) <= set(re.findall("[a-z0-9]+", url))
    assert urls.tokens_of("||casino-*.com^") == ["casino", "com"]
    assert urls.tokens_of("ads*x") == [] and urls.tokens_of("*") == []


def test_patterns_without_tokens_are_run(spark):
    pages = spark.createDataFrame([(1, "http://a.org/qqbad1"), (2, "http://a.org/ok")], "page_id long, url string")
    patterns = (urls.Pattern("block", "bad"), urls.Pattern("block", "/zzz/"))
    assert {r.page_id: r.verdict for r in urls.judge(pages, (), patterns).collect()} == {1: "block", 2: "allow"}


def test_a_large_index_meets_tokens_in_a_shuffle(spark, monkeypatch):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    small = sorted(map(str, urls.judge(pages, HOST_RULES).collect()))
    monkeypatch.setattr(urls, "INDEX_BYTES", 0)
    assert sorted(map(str, urls.judge(pages, HOST_RULES).collect())) == small


def test_many_patterns_without_tokens_in_one_pass(spark):
    urls_ = ["http://a.org/qqbad1", "http://a.org/xxgoodbad", "http://a.org/ok", "http://a.org/okworsex", None]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls_)], "page_id long, url string, host string, verdict string")
    patterns = (urls.Pattern("block", "bad"), urls.Pattern("allow", "good"), urls.Pattern("block", "worse"), urls.Pattern("block", "*qqb*"))
    found = {r.page_id: (r.verdict, r.pattern) for r in urls.judge(pages, (), patterns).collect()}
    assert found == {0: ("block", "*qqb*"), 1: ("allow", "good"), 2: ("allow", None), 3: ("block", "worse"), 4: ("allow", None)}


def test_tokens_are_counted_before_they_move(spark, monkeypatch):
    pages = spark.createDataFrame([("https://www.a.com/ads/x",)] * 50 + [("https://b.com/",)], "url string").distinct()
    patterns = (urls.Pattern("block", "/com/ads/"), urls.Pattern("block", "||www.ads."))
    filed = {r.pattern: r.token for r in urls.index_patterns(pages, patterns).collect()}
    assert filed == {"/com/ads/": "ads", "||www.ads.": "ads"}
    monkeypatch.setattr(urls, "INDEX_BYTES", 0)
    assert {r.pattern: r.token for r in urls.index_patterns(pages, patterns).collect()} == filed


def test_patterns_come_from_a_table(spark, monkeypatch):
    rows = [("Block", " ||ads. "), ("block", "||ads."), ("ALLOW", "/ok/"), ("block", ""), ("block", None), ("x", "! a comment")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "verdict string, pattern string, url int")
    patterns = urls.read_patterns(table)
    assert patterns == (urls.Pattern("allow", "/ok/"), urls.Pattern("block", "||ads."))
    pages = spark.createDataFrame([(1, "http://ads.x.org/"), (2, "http://ads.x.org/ok/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in urls.judge(pages, (), patterns).collect()} == {1: "block", 2: "allow"}
    assert urls.read_patterns(table.where("false")) == ()
    assert {r.verdict for r in urls.judge(pages, (), ()).collect()} == {"allow"}
    with pytest.raises(ValueError, match="verdict"):
        urls.read_patterns(spark.createDataFrame([(None, "a")], "verdict string, pattern string"))
    monkeypatch.setattr(urls, "RULE_BYTES", 3)
    with pytest.raises(ValueError, match="bytes"):
        urls.read_patterns(table)
