import json
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lectern.plans import sinks
from lectern.schemas import ARTICLE_COLUMNS
from lectern.scratch import Scratch
from lectern.sources import articles, feeds, layout

RSS = """<?xml version="1.0"?><rss version="2.0" xmlns:atom="http://a"><channel><title>t</title><link>no</link>
<atom:link href="no"/><item><link>http://a?x=1&amp;y=2</link></item><item><title>none</title></item>
<item><link/></item><item><link><![CDATA[http://c]]></link></item><item><link>http://c</link></item></channel></rss>"""


def write(root, path, text):
    file = Path(root) / path
    file.parent.mkdir(parents=True, exist_ok=True)
    file.write_text(text, encoding="utf-8")


def test_feeds(spark, folder):
    write(folder, "feeds/topic-urls/data/2026-01-05/feed.xml", RSS)
    write(folder, "feeds/topic-urls/one/2026-01-05/feed.xml", "<rss><channel><item><link>l</link></item></channel></rss>")
    write(folder, "feeds/topic-urls/empty/2026-01-05/feed.xml", "<rss><channel></channel></rss>")
    write(folder, "feeds/topic-urls/broken/2026-01-05/feed.xml", "not xml <<")
    found = feeds.read_feeds(spark, folder + "/feeds/*/*/*")
    links = feeds.keep_links(feeds.feed_items(found))
    assert sorted((r["topic"], r["pos"], r["link"]) for r in links.collect()) == [
        ("data", 0, "http://a?x=1&y=2"), ("data", 3, "http://c"), ("data", 4, "http://c"), ("one", 0, "l")
    ]
    empty = feeds.empty_feeds(found).collect()
    assert sorted(r["topic"] for r in empty) == ["broken", "empty"] and empty[0]["run_date"] == "2026-01-05"


def test_feed_errors_stop_the_job_after_they_are_written(spark, folder):
    errors = spark.createDataFrame([("t", "e")], "topic string, error string")
    sinks.write_feed_errors(errors, folder + "/a", "2026-01-05", allow_empty=True)
    with pytest.raises(sinks.EmptyFeedError):
        sinks.write_feed_errors(errors, folder + "/b", "2026-01-05")
    assert spark.read.json(folder + "/b").count() == 1
    sinks.write_feed_errors(errors.where("false"), folder + "/c", "2026-01-05")
    assert not Path(folder, "c").exists()


def test_url_lists(spark, folder):
    write(folder, "a/urls.json", json.dumps({"topic": "t", "timestamp": "x", "urls": ["u1", "u2"]}, indent=2))
    write(folder, "b/urls.json", json.dumps({"urls": ["u3"]}))
    write(folder, "c/urls.json", json.dumps({"topic": "none"}))
    got = feeds.read_url_lists(spark, folder + "/*/urls.json").collect()
    assert sorted((r["topic"], r["pos"], r["url"]) for r in got) == [("t", 0, "u1"), ("t", 1, "u2"), ("unknown", 0, "u3")]
    assert feeds.read_url_lists(spark, folder + "/missing").count() == 0
    write(folder, "d/urls.json", '{"topic": "t", "urls": ["u1"]}\n{"topic": "t", "urls": ["u2"]}\n')
    assert feeds.read_url_lists(spark, folder + "/d", lines=True).count() == 2
    with pytest.raises(PySparkException, match="not one JSON document"):
        feeds.read_url_lists(spark, folder + "/d").collect()


def test_manifests_keep_order(spark, folder):
    write(folder, "manifests/t/2026-01-05/chunk_0.json", json.dumps(["b", "a"], indent=1))
    got = feeds.read_manifests(spark, layout.manifest_glob(folder)).orderBy("pos").collect()
    assert [(r["topic"], r["run_date"], r["manifest"], r["url"]) for r in got] == [
        ("t", "2026-01-05", "chunk_0", "b"), ("t", "2026-01-05", "chunk_0", "a")
    ]


def test_manifest_sink_round_trip(spark, folder):
    links = spark.createDataFrame(
        [("t t", "2026-01-05", i, f"u{i}") for i in range(7)], "topic string, run_date string, pos long, url string"
    )
    sinks.write_manifests(links, folder + "/manifests", size=3)
    files = spark.read.text(folder + "/manifests", wholetext=True)
    rows = feeds.explode_manifest(files).orderBy("block_id", "pos").collect()
    assert [(r["block_id"], r["pos"], r["url"]) for r in rows] == [(i // 3, i % 3, f"u{i}") for i in range(7)]


ROW = {c: None for c in ARTICLE_COLUMNS} | {"article_url": "http://a", "content_gated": False, "title": "t"}


def test_declared_load_skips_bad_records(spark, folder):
    lines = [
        json.dumps(ROW | {"unknown": 1, "clap_count": 5}),
        "{bad",
        json.dumps({"title": "no key"}),
        json.dumps(ROW | {"content_gated": "notabool"}),
    ]
    write(folder, "in/x.json", "\n".join(lines))
    write(folder, "in/skip.txt", "{bad\n" * 50)
    with Scratch(spark) as scratch:
        load = articles.load_bronze(spark, folder + "/in", scratch)
        assert (load.good, load.bad) == (1, 3)
        row = load.rows.first()
        assert load.rows.columns == list(ARTICLE_COLUMNS) and row["clap_count"] == "5"
        with pytest.raises(articles.BadRecordLimitError):
            articles.load_bronze(spark, folder + "/in", scratch, max_bad=2)


def test_inferred_load(spark, folder):
    with Scratch(spark) as scratch:
        read = lambda path: articles.read_inferred(spark, folder + path, scratch)
        assert read("/missing") is None
        write(folder, "empty/x.json", "")
        assert read("/empty") is None
        write(folder, "in/x.json", json.dumps({"article_url": "u", "ingested_at": "2026-01-01T00:00:00Z", "more": 1}))
        row = read("/in").rows.first()
        assert row["article_url"] == "u" and row["title"] is None and row["ingested_at"].year == 2026


def test_inferred_types_and_rejects(spark, folder):
    lines = [
        json.dumps({"article_url": "http://a", "clap_count": 5, "title": "t", "content_gated": True, "topic": {"a": 1}, "comments_count": 1}),
        json.dumps({"article_url": "http://b", "clap_count": 7, "title": None, "content_gated": "true", "topic": "x", "comments_count": "k"}),
        json.dumps({"article_url": "http://c"}) + json.dumps({"article_url": "http://d"}),
        "{bad", "", "[]", "null", "7", json.dumps({"title": "no key"}),
    ]
    write(folder, "in/x.json", "\n".join(lines))
    with Scratch(spark) as scratch:
        load = articles.read_inferred(spark, folder + "/in", scratch)
        assert (load.good, load.bad) == (2, 6) and load.rows.columns == list(ARTICLE_COLUMNS)
        got = {r["article_url"]: r for r in load.rows.collect()}
        a, b = got["http://a"], got["http://b"]
        assert (a["clap_count"], b["clap_count"]) == ("5", "7") and a["content_gated"] is True and b["content_gated"] is True
        assert (a["topic"], b["topic"]) == ('{"a":1}', "x") and (a["comments_count"], b["comments_count"]) == ("1", "k") and b["title"] is None
        left = {(r["record"], r["reason"]) for r in load.rejects.collect()}
        assert left == {(x, "not one JSON record") for x in lines[2:4] + lines[5:8]} | {('{"title":"no key"}', "no article_url")}


def test_article_files(spark, folder):
    good = ROW | {"published_date": "2026-01-05T10:00:00Z", "page_content": "a\nb"}
    write(folder, "in/good-1.json", json.dumps(good, indent=2))
    write(folder, "in/odd.json", json.dumps(ROW | {"content_gated": "notabool", "article_url": "http://b"}))
    write(folder, "in/broken.json", "{bad")
    write(folder, "in/two.json", json.dumps(ROW) + "\n" + json.dumps(ROW))
    write(folder, "in/empty.json", " \n")
    write(folder, "in/other.txt", "{bad")
    rows, broken, files = articles.read_article_files(spark, folder + "/in", Scratch(spark))
    assert files.count() == 5
    got = {r["file_stem"]: r for r in rows.collect()}
    assert set(got) == {"good-1", "odd"}
    assert got["good-1"]["published_date"] == "2026-01-05" and got["good-1"]["content_gated"] is False
    assert got["odd"]["content_gated"] is None
    assert sorted(Path(r["file_path"]).name for r in broken.collect()) == ["broken.json", "empty.json", "two.json"]


def test_path_columns_of_both_layouts(spark, folder):
    write(folder, "raw/articles/my%20topic/2026-01-05/slug-1.json", json.dumps(ROW))
    df = layout.with_path_columns(spark.read.schema("article_url string").json(layout.article_glob(folder)))
    row = df.first()
    assert (row["path_run_date"], row["path_stem"]) == ("2026-01-05", "slug-1")
    sinks.write_bronze(spark.createDataFrame([tuple(ROW.values())], _schema()), folder + "/b/articles", "2026-01-06")
    df = layout.with_path_columns(spark.read.schema("article_url string").json(folder + "/b/articles/*/*"))
    assert df.first()["path_run_date"] == "2026-01-06"


def _schema():
    from lectern.schemas import BRONZE_ARTICLE

    return BRONZE_ARTICLE


def test_manual_list_serves_topics_without_feed(spark):
    schema = "topic string, url string"
    feed = spark.createDataFrame([("a", "f1"), ("a", "f1")], schema)
    manual = spark.createDataFrame([("a", "m1"), ("b", "m2"), ("b", "m3")], schema)
    got = feeds.with_manual_fallback(feed, manual).collect()
    assert sorted(tuple(r) for r in got) == [("a", "f1"), ("a", "f1"), ("b", "m2"), ("b", "m3")]


def test_prepared_documents_of_a_day(spark, folder):
    row = ROW | {"published_date": "2026-01-05", "page_content": "x"}
    frame = spark.createDataFrame([tuple(row.values())], _schema()).withColumn(
        "published_date", F.col("published_date").cast("date")
    )
    for _ in range(2):  # overwrites
        sinks.export_documents(frame, folder + "/x", "2026-01-05")
    assert spark.read.json(folder + "/x").count() == 1
    assert sinks.prepared_documents(frame, "2026-01-06").count() == 0
    assert sinks.prepared_documents(frame.withColumn("content_gated", F.lit(None).cast("boolean")), "2026-01-05").count() == 0
