import datetime as dt
import hashlib
import subprocess
import sys
import time

import pytest
from pyspark import cloudpickle

from lectern.operators import extract as extracting
from lectern.operators import sizing
from lectern.operators.extract import extract_articles, page_parts, split_errors

STAMP = dt.datetime(2026, 1, 2, 3, 4, 5)
BODY = "word " * 60


def extract(spark, html, **options):
    df = spark.createDataFrame([("http://x/a", "t", html)], "url string, topic string, html string")
    return extract_articles(df, STAMP, **options).first().asDict()


FULL = f"""<html><head>
<meta content="OG" property="og:title"><meta name="author" content="Ann">
<meta property="article:published_time" content="2026-01-01T00:00:00Z"><meta property="og:image" content="i.png">
<title> T </title></head><body><h1> H </h1><article>
<p> one &amp; <b>two</b> </p><p></p><p>{BODY}</p></article>
<button data-testid="headerClapButton"> 5.<span>5k</span></button>
<button aria-label="responses">7</button><span data-testid="clapCount">6k</span>
<i data-testid="responsesCount"> 8 </i></body></html>"""


def test_head_fields_win(spark):
    got = extract(spark, FULL)
    assert got["article_url"] == "http://x/a" and got["topic"] == "t"
    assert (got["title"], got["author_name"], got["published_date"]) == ("OG", "Ann", "2026-01-01T00:00:00Z")
    assert got["hero_image_url"] == "i.png" and got["author_avatar_url"] is None
    assert got["page_content"] == f"one & two\n\n\n\n{BODY.strip()}"
    assert got["first_line"] == "one & two"
    assert (got["clap_count"], got["comments_count"]) == ("5.5k", "7")
    assert got["content_hash"] == hashlib.sha256(got["page_content"].encode()).hexdigest()
    assert got["content_gated"] is False and got["ingested_at"] == STAMP and got["error"] is None


def test_empty_head_values_fall_through(spark):
    html = """<meta property="og:title" content=""><meta name="author"><h1>H</h1><h1>I</h1>
    <a data-testid="authorName"> Bo </a><time>x</time><time datetime="2026">y</time><section><p>s</p><p>u</p></section>"""
    got = extract(spark, html)
    assert (got["title"], got["author_name"]) == ("H", "Bo")
    assert got["published_date"] is None  # the first time element decides
    assert got["page_content"] == "s\n\nu" and got["first_line"] == "s" and got["content_gated"] is True
    assert got["clap_count"] is None and got["comments_count"] is None and got["hero_image_url"] is None


def test_bare_page(spark):
    got = extract(spark, "<p>outside</p>")
    assert (got["title"], got["author_name"], got["page_content"], got["first_line"]) == ("", "", "", None)


def test_legacy_rules(spark):
    got = extract(spark, FULL, rules="legacy")
    assert got["page_content"].startswith("one & two") and "\n\n\n\n" not in got["page_content"]
    assert got["content_hash"] == hashlib.md5(got["page_content"].encode()).hexdigest()
    assert (got["clap_count"], got["comments_count"], got["first_line"]) == ("6k", "8", "one & two")
    html = """<meta property="og:title" content=""><h1>H</h1><time>x</time><time datetime="2026">y</time>
    <figure><img src="f.png"></figure><section><p>s </p><p>u</p></section>"""
    got = extract(spark, html, rules="legacy")
    assert got["title"] == ""  # an empty head value counts here
    assert (got["published_date"], got["hero_image_url"], got["page_content"]) == ("2026", "f.png", "s \nu")
    assert extract(spark, "<p>x", rules="legacy")["page_content"] is None


def test_json_ld_author(spark):
    html = '<script type="application/ld+json">{"author": {"name": "Cy"}}</script><h1>x</h1>'
    assert extract(spark, html)["author_name"] == ""
    assert extract(spark, html, json_ld_author=True)["author_name"] == "Cy"


@pytest.mark.parametrize(
    "html, paragraphs",
    [
        ("<article><p>a<p>b</article><p>c", ["a", "b"]),
        ("<article><p><b>a<br><p>b</b> c</p></article>", ["a", "b c"]),
        ("<article><p>a<div>no</div>no</p></article>", ["a", ""]),
        ("<article><div><p>a</div>no<p>b</article>", ["a", "b"]),
        ("<article><p>a<span>b</article>no", ["ab"]),
        ("<article><p>a<script>var p='</p>'</script>b<style>p{}</style></p></article>", ["ab"]),
        ("<article><p>a<!-- no --> b &lt;i&gt; &nbsp;</p></article>", ["a b <i> \xa0"]),
        ("<article><ul><li><p>a<li><p>b</ul></article>", ["a", "b"]),
        ("<article><table><tr><td><p>a</td><td>no</td></tr></table><p>b</article>", ["a", "b"]),
        ("<ARTICLE><P>a</P></ARTICLE>", ["a"]),
        ("<article><section><p>a</p></section></article>", ["a"]),
        ("<article><p>a<img src=x>b<br/>c</p>", ["abc"]),
    ],
)
def test_paragraphs_close_as_in_a_browser(html, paragraphs):
    assert page_parts(html)["article_p_list"] == paragraphs


def test_failures_become_error_rows_and_the_batch_goes_on(spark):
    df = spark.createDataFrame(
        [("u1", "t", None), ("u2", "t", "<article><p>ok</p></article>"), ("u3", "t", "<![bad")],
        "url string, topic string, html string",
    )
    good, bad = split_errors(extract_articles(df, STAMP))
    urls = {r["article_url"] for r in good.collect()}
    failed = {r["url"]: r for r in bad.collect()}
    assert "u2" in urls and "u1" in failed and urls | set(failed) == {"u1", "u2", "u3"}
    assert failed["u1"]["error"] and failed["u1"]["failed_at"] == STAMP and failed["u1"]["topic"] == "t"


def test_pages_are_parsed_once(spark):
    df = spark.createDataFrame([("u", "t", FULL)], "url string, topic string, html string")
    plan = extract_articles(df, STAMP)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_workers_need_no_copy_of_the_package(tmp_path):
    (tmp_path / "f").write_bytes(cloudpickle.dumps(page_parts))
    code = "import pickle; print(pickle.load(open('f', 'rb'))('<article><p>x')['article_p_list'])"
    found = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert found.stdout.strip() == "['x']"


def test_unclosed_tags_cost_linear_time():
    begun = time.time()
    for unit in ("<b>x", "<b><p>x", "<i></p>", "<h1><b>x", "<li>x", "<td>x"):
        assert page_parts("<article><p>first" + unit * 50_000)["error"] is None
    assert time.time() - begun < 60


def test_python_holds_few_pages_at_once(spark):
    assert [list(range(a, b)) for a, b in extracting._stretches(["x" * 60, None, "y" * 50, "z" * 300, "", "q"], 100)] == [[0, 1, 2], [3], [4, 5]]
    before = spark.conf.get(sizing.BATCH_SETTING)
    spark.conf.set(sizing.BATCH_SETTING, "10000")
    try:
        pages = spark.range(3000).selectExpr("concat('u', id) url", "'t' topic", "concat('<article><p>', repeat(id, 600)) html").coalesce(1)
        found = {r["article_url"]: r["page_content"] for r in extract_articles(pages, STAMP).collect()}
        assert int(spark.conf.get(sizing.BATCH_SETTING)) <= extracting.BATCH_PAGES
        assert found == {f"u{i}": str(i) * 600 for i in range(3000)}
    finally:
        spark.conf.set(sizing.BATCH_SETTING, before)
