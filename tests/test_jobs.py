from pathlib import Path

import pytest

from lectern import jobs
from lectern.plans.sinks import EmptyFeedError
from tests.test_pipeline import DAY, page, pages


def model():
    return lambda prompts: ["seen" for _ in prompts]


def test_all_jobs_in_order(spark, folder):
    root, common = folder + "/lake", ["--root", folder + "/lake", "--date", DAY]
    feed = Path(folder, "feeds/topic-urls/t", DAY, "feed.xml")
    feed.parent.mkdir(parents=True)
    feed.write_text("<rss><channel><item><link>http://x/a</link></item><item><link>http://x/b</link></item></channel></rss>")
    assert jobs.main(["discover", "--feeds", folder + "/feeds/*/*/*/*.xml", *common]) == {"urls": 2}
    rows = pages(spark, ("http://x/a", "t", page("red fox " * 50)), ("http://x/b", "t", page("blue sea " * 50)))
    rows.write.parquet(folder + "/pages")
    assert jobs.main(["land", "--pages", folder + "/pages", *common]) == {"pages": 2, "errors": 0}
    assert jobs.main(["load", *common])["rows_merged"] == 2
    # the file loader wants one document per file: these are JSON lines, none of which may be lost half
    assert jobs.main(["load", "--loader", "files", *common])["rows_merged"] == 0
    assert jobs.main(["load", "--loader", "inferred", *common])["rows_merged"] == 2
    assert jobs.main(["index", "--stamp", "2026-01-06", *common]) == {"gold_partitions": 1, "undated": 0}
    assert jobs.main(["export", "--out", folder + "/out", *common]) == {"documents": 2}
    asked = spark.createDataFrame([(1, "fox"), (2, "")], "question_id int, query string")
    asked.write.parquet(folder + "/asked")
    ask = ["ask", "--questions", folder + "/asked", "--model", "tests.test_jobs:model", "--out", folder + "/answers"]
    assert jobs.main([*ask, *common]) == {"answers": 1}
    assert spark.read.parquet(folder + "/answers").first()["answer"] == "seen"
    assert Path(root, "silver").exists()


def test_empty_feed_stops_discovery(spark, folder):
    feed = Path(folder, "feeds/topic-urls/t", DAY, "feed.xml")
    feed.parent.mkdir(parents=True)
    feed.write_text("<rss><channel></channel></rss>")
    run = ["discover", "--feeds", folder + "/feeds/*/*/*/*.xml", "--root", folder, "--date", DAY]
    with pytest.raises(EmptyFeedError):
        jobs.main(run)
    assert jobs.main([*run, "--allow-empty"]) == {"urls": 0}


def test_discovery_orders_feeds_and_keeps_days(spark, folder):
    def feed(path, *links):
        file = Path(folder, path)
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(f"<rss><channel>{''.join(f'<item><link>{x}</link></item>' for x in links)}</channel></rss>")

    other = "2026-01-06"
    feed(f"feeds/topic-urls/t/{DAY}/b.xml", "u3", "u4")
    feed(f"feeds/topic-urls/t/{DAY}/a.xml", "u1", "u2")
    feed(f"feeds/topic-urls/t/{other}/a.xml", "u9")
    feed(f"feeds/topic-urls/s/{DAY}/a.xml")
    feed("feeds/elsewhere/x/y/lost.xml", "u5")
    root = folder + "/lake"
    run = ["discover", "--feeds", folder + "/feeds/*/*/*/*.xml", "--root", root, "--date", DAY]
    for _ in range(2):
        with pytest.raises(EmptyFeedError):
            jobs.main(run)
    lists = spark.read.json(root + "/raw/topic-urls")
    assert {(r.topic, str(r.run_date), tuple(r.urls)) for r in lists.collect()} == {("t", DAY, ("u1", "u2", "u3", "u4")), ("t", other, ("u9",))}
    errors = spark.read.json(root + "/errors").select("topic", "url", "error").collect()
    assert sorted((r.topic, r.url.rsplit("/", 1)[1], r.error) for r in errors) == [
        ("s", "a.xml", "Feed empty or failed to parse"),
        ("unknown", "lost.xml", "Feed file outside the layout"),
    ]
