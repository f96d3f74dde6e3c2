import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.functions.embedding import FunctionEmbedder, HashingEmbedder
from lectern.plans import pipeline
from lectern.plans.journal import Journal
from lectern.registry.retrieval import first_context
from lectern.schemas import UPDATE_ALL
from lectern.sources.articles import BadRecordLimitError, read_gold, read_silver

STAMP = dt.datetime(2026, 1, 5, 6)
DAY = "2026-01-05"
EMBEDDER = HashingEmbedder(16)


def page(text, day=DAY):
    return (f'<meta property="og:title" content="T {text[:3]}"><meta property="article:published_time" content="{day}T01">'
            f"<article><p>{text}</p></article>")


def pages(spark, *rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "pos long, url string, topic string, html string")


def snapshot(spark, root):
    silver = sorted(map(str, read_silver(spark, root + "/silver").collect()))
    return silver, sorted(map(str, read_gold(spark, root + "/gold").collect()))


def test_a_day_from_pages_to_answers_twice(spark, folder):
    fox, sea = "red fox " * 40, "blue sea " * 40
    rows = pages(
        spark,
        ("http://x/fox?a=1", "animals", page(fox)),
        ("http://x/fox?a=2", "animals", page("second page on the same path " * 20)),
        ("http://x/sea", "water", page(sea)),
        ("http://x/old", "water", page(sea, "2025-01-01")),
        ("http://x/short", "water", page("short")),
        ("http://x/none", "water", None),
    )
    counts = pipeline.run_pipeline(spark, rows, folder, DAY, EMBEDDER, STAMP)
    assert counts["pages"] == 5 and counts["errors"] == 1 and counts["rows_loaded"] == 4
    assert counts["violations"] == 1 and counts["silver_partitions"] == 2
    assert spark.read.json(folder + "/errors").select("url").first()[0] == "http://x/none"
    before = snapshot(spark, folder)
    assert {r["article_url"] for r in read_gold(spark, folder + "/gold").collect()} == {"http://x/fox?a=1", "http://x/sea"}
    again = pipeline.run_pipeline(spark, rows, folder, DAY, EMBEDDER, STAMP)
    assert again["rows_loaded"] == 4 and snapshot(spark, folder) == before
    asked = spark.createDataFrame([(1, "blue sea"), (2, " ")], "question_id int, query string")
    got = pipeline.ask(spark, asked, folder, EMBEDDER, lambda: first_context).collect()
    assert [(r["question_id"], r["answer"]) for r in got] == [(1, "http://x/sea")]
    assert pipeline.skipped_by_index(spark, folder + "/silver") == 0


def test_collector_reads_plain_folders_of_one_topic(spark, folder):
    for topic in ("a", "b"):
        file = Path(folder, "raw/articles", topic, DAY, "slug.json")
        file.parent.mkdir(parents=True)
        file.write_text(json.dumps({"article_url": f"http://{topic}", "title": "t", "page_content": "x " * 200,
                                    "published_date": DAY, "content_gated": False}) + "\n{bad")
    collector = pipeline.ArticleCollector(spark, folder, EMBEDDER, topic="a", stamp=STAMP)
    assert collector.process(DAY)["rows_loaded"] == 1
    assert [r["article_url"] for r in read_silver(spark, folder + "/silver").collect()] == ["http://a"]
    strict = pipeline.ArticleCollector(spark, folder, EMBEDDER, topic="b", stamp=STAMP, max_bad=0)
    with pytest.raises(BadRecordLimitError):
        strict.load(DAY)


def test_older_loaders(spark, folder):
    file = Path(folder, "in", "x.json")
    file.parent.mkdir()
    file.write_text(json.dumps({"article_url": "http://a", "title": "t", "published_date": "2026-01-05T10"}))
    silver = folder + "/silver"
    assert pipeline.load_files(spark, folder + "/in", silver, UPDATE_ALL) == 1
    assert pipeline.load_inferred(spark, folder + "/in", silver) == 1
    assert pipeline.load_inferred(spark, folder + "/missing", silver) == 0
    row = read_silver(spark, silver).select("article_url", F.col("published_date").cast("string")).collect()
    assert [tuple(r) for r in row] == [("http://a", DAY)]


def test_every_rejected_record_is_kept(spark, folder):
    file = Path(folder, f"raw/articles/t/{DAY}/a.json")
    file.parent.mkdir(parents=True)
    good = {"article_url": "http://x/1", "title": "T", "page_content": "word } { " * 60}
    short = {**good, "article_url": "http://x/2", "page_content": "s"}
    lines = [json.dumps(good), json.dumps(good) + json.dumps(short), json.dumps(good) + "," + json.dumps(short), "{bad", "", json.dumps({"title": "x"}), json.dumps([good]), json.dumps(short)]
    file.write_text("\n".join(lines))
    collector = pipeline.ArticleCollector(spark, folder, HashingEmbedder(8), on_violation="quarantine")
    for _ in range(2):
        counts = collector.load(DAY)
    assert (counts["rows_loaded"], counts["bad_records"], counts["rows_merged"]) == (2, 5, 1)
    found = Journal(spark, folder + "/rejects", DAY).read().collect()
    assert {(r.topic, Path(r.file).name, r.run) for r in found} == {("t", "a.json", DAY)}
    assert sorted(r.record for r in found if r.reason == "not one JSON record") == sorted([lines[1], lines[2], lines[3], lines[6]])
    assert sorted((r.step, r.reason) for r in found if r.reason != "not one JSON record") == [("contract", "Content too short"), ("load", "no article_url")]


def test_records_of_other_topics_stay_and_refused_loads_are_recorded(spark, folder):
    good = {"article_url": "http://x/1", "title": "T", "page_content": "word " * 60}
    for topic, lines in (("a", ["{a"]), ("b", ["{b1", "{b2"]), ("c", ["{c", json.dumps(good)])):
        file = Path(folder, f"raw/articles/{topic}/{DAY}/f.json")
        file.parent.mkdir(parents=True)
        file.write_text("\n".join(lines))
    journal = Journal(spark, folder + "/rejects", DAY)
    recorded = lambda: sorted((r.step, r.topic, r.record) for r in journal.read().collect())
    load = lambda topic, **options: pipeline.ArticleCollector(spark, folder, EMBEDDER, topic, **options).load(DAY)
    load("a")
    with pytest.raises(BadRecordLimitError):
        load("b", max_bad=1)
    assert recorded() == [("load", "a", "{a"), ("load", "b", "{b1"), ("load", "b", "{b2")]
    c = pipeline.ArticleCollector(spark, folder, EMBEDDER, "c")
    assert pipeline.load_inferred(spark, c.extract(DAY), c.silver, c.rejects, DAY) == 1
    Path(folder, f"raw/articles/b/{DAY}/f.json").write_text("{b2")  # one line was mended
    load("b", max_bad=1)
    assert recorded() == [("inferred", "c", "{c"), ("load", "a", "{a"), ("load", "b", "{b2")]
    load("*")
    assert recorded() == [("inferred", "c", "{c"), ("load", "a", "{a"), ("load", "b", "{b2"), ("load", "c", "{c")]


def test_an_inferred_load_that_fails_is_a_warning(spark, folder, caplog):
    file = Path(folder, "in", "x.json")
    file.parent.mkdir()
    file.write_text(json.dumps({"article_url": "http://a", "title": "t"}))
    Path(folder, "silver/commits/version=1").mkdir(parents=True)
    Path(folder, "silver/commits/version=1/x.json").write_text('{"kind":"head","lines":2,"base":0,"run":"r"}\n{"kind":"rows","commit":1,"run":"gone","rows":1,"bytes":1,"hidden_rows":0,"hidden_bytes":0,"parts":1}')
    assert pipeline.load_inferred(spark, folder + "/in", folder + "/silver") == 0
    assert "load failed" in caplog.text


def test_a_day_without_files_changes_nothing(spark, folder):
    counts = pipeline.ArticleCollector(spark, folder, HashingEmbedder(8)).process(DAY)
    assert counts["rows_loaded"] == 0 and counts["rows_merged"] == 0


def test_errors_are_replaced_when_pages_are_tried_again(spark, folder):
    def errors():
        return sorted((r.topic, r.url) for r in spark.read.schema("topic string, url string").json(folder + "/errors").collect())

    stamp = dt.datetime(2026, 1, 5)
    first = pages(spark, ("http://x/a", "t", None), ("http://x/b", "t", None), ("http://x/c", "s/1", None))
    for _ in range(2):
        assert pipeline.land_pages(spark, first, folder, DAY, stamp)["errors"] == 3
        assert errors() == [("s/1", "http://x/c"), ("t", "http://x/a"), ("t", "http://x/b")]
    again = pages(spark, ("http://x/a", "t", page("red " * 60)), ("http://x/c", "s/1", page("sea " * 60)))
    assert pipeline.land_pages(spark, again, folder, DAY, stamp) == {"pages": 2, "errors": 0}
    assert errors() == [("t", "http://x/b")]


def test_pages_landed_as_one_file_each_are_skipped(spark, folder):
    file = Path(folder, f"raw/articles/t/{DAY}/a.json")
    file.parent.mkdir(parents=True)
    file.write_text(json.dumps({"article_url": "http://x/a", "topic": "t"}))
    both = pages(spark, ("http://x/a", "t", page("red " * 60)), ("http://x/b", "t", page("sea " * 60)))
    assert pipeline.land_pages(spark, both, folder, DAY, dt.datetime(2026, 1, 5))["pages"] == 1


def refusing():
    def model(texts):
        raise ValueError("down")

    return model


def test_a_model_that_is_down_fails_the_index(spark, folder):
    collector = pipeline.ArticleCollector(spark, folder, FunctionEmbedder(refusing))
    stamp = dt.datetime(2026, 1, 5)
    html = page("red fox " * 60).replace("<head>", f'<head><meta property="article:published_time" content="{DAY}">')
    pipeline.land_pages(spark, pages(spark, ("http://x/a", "t", html)), folder, DAY, stamp)
    collector.load(DAY)
    collector.index_by = "ingested"
    with pytest.raises(Exception, match="embedding failed: ValueError: down"):
        collector.index(DAY)


def test_html_is_never_shuffled(spark, folder, monkeypatch):
    """Whether few or many pages are chosen, no exchange below the parser carries HTML, and the same pages land."""
    rows = [(f"http://x/{i % 50}", f"t{i % 3}", page(f"text {i} " * 40)) for i in range(200)]
    pages(spark, *rows).write.parquet(folder + "/pages")
    stored = spark.read.parquet(folder + "/pages")
    landed = []
    for few in (1000, 0):
        root = f"{folder}/{few}"
        assert pipeline.land_pages(spark, stored, root, DAY, STAMP, few=few) == {"pages": 150, "errors": 0}
        assert pipeline.land_pages(spark, stored, root, DAY, STAMP, few=few) == {"pages": 0, "errors": 0}
        back = spark.read.schema("article_url string, topic string, content_hash string").json(root + "/raw/articles")
        landed.append(sorted(tuple(r)[:3] for r in back.collect()))
        chosen = stored.select("pos").where("pos % 2 = 0")
        todo, exact = pipeline._only(stored, chosen, "pos", few)
        plan = todo._jdf.queryExecution().executedPlan().toString()
        exchanges = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
        assert not exchanges and "SortMergeJoin" not in plan and exact is (few > 0)
        assert {r[0] for r in chosen.collect()} <= {r[0] for r in todo.select("pos").collect()}
    assert landed[0] == landed[1]


def test_filter_passes_all_keys_and_few_others(spark):
    from lectern.operators.bloom import in_filter

    keys = spark.range(0, 20_000, 2)
    passed = {r[0] for r in spark.range(20_000).where(in_filter("id", keys, 1 << 14)).collect()}
    assert set(range(0, 20_000, 2)) <= passed and len(passed) < 10_500
