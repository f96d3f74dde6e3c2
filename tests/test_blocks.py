import random

import pytest
from pyspark.sql import functions as F

from lectern.operators.blocks import list_documents, with_blocks


@pytest.mark.parametrize("kind", ["dense", "sparse", "wide"])
@pytest.mark.parametrize("parts", [1, 7])
def test_positions_equal_a_sorted_list(spark, kind, parts):
    rng = random.Random(parts)
    step = {"dense": 1, "sparse": 1 << 32, "wide": 1 << 40}[kind]
    rows = [(rng.choice(["hot", "hot", "b", None]), o * step) for o in rng.sample(range(-50, 5000), 400)]
    df = spark.createDataFrame(rows, "topic string, pos long")
    got = {(r["topic"], r["pos"]): (r["position"], r["block_id"]) for r in with_blocks(df, ["topic"], "pos", 30, parts).collect()}
    expected = {}
    for topic in {t for t, _ in rows}:
        for i, p in enumerate(sorted(o for t, o in rows if t == topic)):
            expected[topic, p] = (i, i // 30)
    assert got == expected


def test_repeating_order_and_one_hot_topic_are_split(spark):
    """A topic of nearly all rows, all of them at one place of the order: numbered without gaps, over many ranges."""
    df = spark.range(0, 40_000, 1, 4).selectExpr("case when id % 100 = 0 then 'b' else 'hot' end topic", "id % 2 pos", "concat('u', id) url")
    out = with_blocks(df, ["topic"], "pos", 100, 16)
    rows = out.collect()
    for topic in ("hot", "b"):
        own = sorted((r["position"], r["pos"]) for r in rows if r["topic"] == topic)
        assert [p for p, _ in own] == list(range(len(own))) and [o for _, o in own] == sorted(o for _, o in own)
    assert sorted(map(str, rows)) == sorted(map(str, with_blocks(df.repartition(9), ["topic"], "pos", 100, 5).collect()))
    staged = spark.read.parquet(next(p for p in out.inputFiles()).rsplit("/", 1)[0])
    ranges = staged.groupBy(F.shiftright("__place", 33)).count().collect()
    assert len(ranges) == 16 and max(r["count"] for r in ranges) < 2 * 40_000 / 16


def test_empty_list_has_no_blocks(spark):
    assert with_blocks(spark.createDataFrame([], "topic string, pos long"), ["topic"], "pos").count() == 0


def test_documents_keep_order_and_size(spark):
    df = spark.createDataFrame([("t", i, f"u{i}") for i in range(25)], "topic string, pos long, url string")
    got = list_documents(with_blocks(df, ["topic"], "pos", 10), ["topic"], "url").orderBy("block_id").collect()
    assert [r["urls"] for r in got] == [[f"u{i}" for i in range(a, min(a + 10, 25))] for a in (0, 10, 20)]
