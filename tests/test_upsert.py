import datetime as dt

import pytest
from pyspark.errors import PySparkException

from lectern.operators import upsert
from lectern.schemas import ARTICLE_COLUMNS, SILVER_ARTICLE, UPDATE_ALL, UPDATE_PARTIAL


def article(url, tag, day=dt.date(2026, 1, 1), at=1, content_hash=None):
    row = {c: f"{tag}-{c}" for c in ARTICLE_COLUMNS}
    row.update(
        article_url=url,
        published_date=day,
        ingested_at=dt.datetime(2026, 1, 1, 0, 0, at),
        content_hash=content_hash or f"{tag}-hash",
        content_gated=tag == "new",
    )
    return tuple(row[c] for c in ARTICLE_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SILVER_ARTICLE)


def by_url(df):
    return {r["article_url"]: r.asDict() for r in df.collect()}


@pytest.mark.parametrize("join", [upsert.upsert, upsert.upsert_in_place])
@pytest.mark.parametrize("update", [UPDATE_PARTIAL, UPDATE_ALL])
def test_update_columns(spark, join, update):
    target = frame(spark, article("a", "old"), article("b", "old"))
    source = frame(spark, article("b", "new"), article("c", "new"))
    got = by_url(join(target, source, update_cols=update))
    assert set(got) == {"a", "b", "c"}
    old, new = by_url(target), by_url(source)
    assert got["a"] == old["a"] and got["c"] == new["c"]
    for c in ARTICLE_COLUMNS:
        assert got["b"][c] == (new if c in update else old)["b"][c]


def test_partial_update_leaves_six_columns():
    assert len(UPDATE_PARTIAL) == 7 and len(UPDATE_ALL) == 13


@pytest.mark.parametrize("join", [upsert.upsert, upsert.upsert_in_place])
def test_null_values_of_the_source_overwrite(spark, join):
    source = frame(spark, article("a", "new")).selectExpr(
        *["cast(null as string) as title" if c == "title" else c for c in ARTICLE_COLUMNS]
    )
    assert by_url(join(frame(spark, article("a", "old")), source))["a"]["title"] is None


def test_latest_per_key(spark):
    rows = [article("hot", f"t{i}", at=i % 50) for i in range(500)] + [article("one", "x")]
    got = by_url(upsert.latest_per_key(frame(spark, *rows)))
    assert set(got) == {"hot", "one"}
    assert got["hot"]["ingested_at"].second == 49
    assert got["hot"]["content_hash"] == min(f"t{i}-hash" for i in range(49, 500, 50))


def test_latest_per_key_limits_groups_before_the_shuffle(spark):
    plan = upsert.latest_per_key(frame(spark, article("a", "x")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_missing_key_fails_the_job(spark):
    with pytest.raises(PySparkException, match="article_url is required"):
        upsert.require_key(frame(spark, article(None, "x"))).collect()


def test_delete_by_key_ignores_null_keys(spark):
    rows = spark.createDataFrame([("a",), ("b",), (None,)], "article_url string")
    keys = spark.createDataFrame([("a",), (None,)], "article_url string")
    assert sorted(str(r[0]) for r in upsert.delete_by_key(rows, keys).collect()) == ["None", "b"]


def test_changed_records_is_null_safe(spark):
    schema = "article_url string, content_hash string"
    existing = spark.createDataFrame([("a", "1"), ("b", None)], schema)
    incoming = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None), ("b", "3"), ("c", None)], schema)
    got = sorted((r[0], r[1]) for r in upsert.changed_records(incoming, existing).collect() if r[1])
    assert got == [("a", "2"), ("b", "3")]
    assert upsert.changed_records(incoming, existing).count() == 3


def test_chunk_upsert_keeps_stale_ids(spark):
    schema = "chunk_id string, document string"
    target = spark.createDataFrame([("h_chunk_0", "old"), ("h_chunk_1", "old")], schema)
    source = spark.createDataFrame([("h_chunk_0", "new")], schema)
    got = {r["chunk_id"]: r["document"] for r in upsert.upsert_chunks(target, source).collect()}
    assert got == {"h_chunk_0": "new", "h_chunk_1": "old"}


def test_skip_landed(spark):
    schema = "topic string, run_date string, slug string, pos int"
    rows = spark.createDataFrame(
        [("t", "d", "a", 2), ("t", "d", "a", 1), ("t", "d", "b", 3), ("u", "d", "b", 4)], schema
    )
    landed = spark.createDataFrame([("t", "d", "b", 0)], schema)
    todo = upsert.skip_landed(upsert.first_landing(rows, "pos"), landed)
    assert sorted((r["topic"], r["slug"], r["pos"]) for r in todo.collect()) == [("t", "a", 1), ("u", "b", 4)]


def test_settled_moves_rows_only_of_keys_that_repeat(spark):
    from lectern.operators.upsert import latest_per_key, settled
    from lectern.scratch import Scratch

    rows = [(f"k{i}", f"d{i}") for i in range(50)] + [("k3", "c"), ("k3", "e"), (None, "n"), (None, "m")]
    with Scratch(spark) as scratch:
        stored = scratch.write(spark.createDataFrame(rows, "k string, d string"))
        plain = sorted(map(str, latest_per_key(stored, ["k"], [stored["d"]]).collect()))
        for most in (1 << 20, 0):
            found = settled(stored.where("k is not null"), "k", [stored["d"]], scratch, most)
            assert sorted(map(str, found.collect())) == [p for p in plain if "None" not in p]
        single = settled(stored.where("k = 'k7'"), "k", [stored["d"]], scratch, 0)
        assert single.count() == 1 and "Exchange" not in single._jdf.queryExecution().executedPlan().toString()


def test_a_collection_is_filled_without_moving_its_documents(spark, tmp_path):
    """What one load shuffles grows with its keys, not with its documents."""
    from lectern.functions.embedding import HashingEmbedder
    from lectern.plans import tables

    chunks = spark.range(300).selectExpr("concat('c', id % 290) chunk_id", "repeat(cast(id as string), 20) document", "named_struct('source', 's', 'title', 't', 'author', 'a') metadata")
    path = str(tmp_path / "collection")
    for _ in range(2):
        tables.upsert_collection(spark, path, chunks, HashingEmbedder(8))
    held = {r["chunk_id"]: r["document"] for r in tables.collection_at(spark, path).read().collect()}
    assert held == {f"c{i}": min(str(j) * 20 for j in range(i, 300, 290)) for i in range(290)}


@pytest.mark.parametrize("update", [UPDATE_PARTIAL, UPDATE_ALL])
def test_matched_rows_are_compared_by_what_they_keep(spark, update):
    """Where every key of the target is in the source, the result is that of the upsert, without the target's texts."""
    same = article("b", "old")
    gone = tuple(None if c == "author_name" else v for c, v in zip(ARTICLE_COLUMNS, article("d", "old"), strict=True))
    target = frame(spark, article("a", "old"), same, gone)
    source = frame(spark, article("a", "new"), same, article("c", "new"), article("d", "old"))
    kept = upsert.kept_columns(update)
    apart = upsert.kept_apart(target, source, "article_url", kept)
    assert {r[0] for r in apart.collect()} == ({"a", "d"} if kept else set())
    assert "page_content" not in apart.columns and "article_url" in apart.columns
    assert by_url(upsert.upsert_kept(source, apart, "article_url", kept)) == by_url(upsert.upsert(target, source, update_cols=update))
