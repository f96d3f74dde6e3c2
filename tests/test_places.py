"""Rows left out by where they are stored, and what uses it."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.functions.embedding import HashingEmbedder
from lectern.operators.places import FILE, INDEX, placed, without
from lectern.operators.upsert import latest_per_key, settled
from lectern.plans import keyed, tables
from lectern.scratch import _CLEANUP, Scratch
from tests.test_keyed import content, put, rows, table


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_rows_are_left_out_by_place(spark, limit):
    """Files of several bitmaps and of a few rows; the last bits, whole files and places of no row."""
    with Scratch(spark) as scratch:
        stored = scratch.write(spark.range(0, 70_000, 1, 1).unionByName(spark.range(70_000, 70_020, 1, 3)))
        gone = "id in (0, 7, 8, 32767, 32768, 65535, 65536, 69999) or id between 40000 and 50000 or id >= 70010"
        places = placed(stored).where(gone).select(FILE, INDEX).unionByName(spark.createDataFrame([("no file", 3)], f"{FILE} string, {INDEX} long"))
        found = without(placed(stored), places, scratch, limit)
        assert found.columns == ["id"]
        assert sorted(r[0] for r in found.collect()) == sorted(r[0] for r in stored.where(f"not ({gone})").collect())
        assert without(placed(stored), places.limit(0), scratch, limit).count() == 70_020


def test_hidden_keys_beyond_a_broadcast_are_never_sent(spark, folder, monkeypatch):
    """Folders that are written anew are read without a broadcast of the keys that hide their rows."""
    t = table(spark, folder)
    put(spark, t, rows(spark, 0, 6000, "a", 3, 100))
    monkeypatch.setattr(keyed, "BROADCAST_BYTES", 40_000)
    monkeypatch.setattr(keyed.KeyedTable, "_hiding", lambda *_: pytest.fail("keys are sent"))
    change = put(spark, t, rows(spark, 0, 4000, "b", 3, 100), small=False)
    assert change.hidden_rows == 4000 and change.rewritten > 0 and not t.version().of("gone")
    assert content(t) == {i: "b" if i < 4000 else "a" for i in range(6000)}


def test_many_repeated_keys_move_without_their_rows(spark):
    with Scratch(spark) as scratch:
        stored = scratch.write(spark.range(0, 3000, 1, 2).selectExpr("concat('k', id % 900) k", "id % 1700 at", "repeat(cast(id as string), 30) d"))
        order = [stored["at"].desc()]
        found = settled(stored, "k", order, scratch, 20_000)
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(found.collect()) == sorted(latest_per_key(stored, ["k"], order).collect())


def test_chunks_are_stored_once_and_chosen_by_the_order_given(spark, folder, monkeypatch):
    written, write = [], Scratch.write
    monkeypatch.setattr(Scratch, "write", lambda self, df, *a: written.append(df.columns) or write(self, df, *a))
    chunks = spark.range(300).selectExpr(
        "concat('c', id % 290) chunk_id", "repeat(cast(id as string), 20) document", "named_struct('source', 's', 'title', 't', 'author', 'a') metadata", "id at"
    )
    for _ in range(2):
        tables.upsert_collection(spark, folder, chunks, HashingEmbedder(8), order=[F.col("at").desc()])
    held = {r["chunk_id"]: r["document"] for r in tables.collection_at(spark, folder).read().collect()}
    assert held == {f"c{i}": str(max(range(i, 300, 290))) * 20 for i in range(290)}
    assert sum("document" in columns for columns in written) == 2


def test_a_stage_leaves_no_shuffle_files(spark):
    """Its shuffle goes when it is written; the session's own setting is as it was."""
    folders = [Path(str(d)) for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    held, shuffles = spark.conf.get(_CLEANUP, None), lambda: {f for d in folders for f in d.glob("*/shuffle_*.data")}
    with Scratch(spark) as scratch:
        before = shuffles()
        stored = scratch.write(spark.range(1000).repartition(3, "id"))
        assert shuffles() <= before and stored.count() == 1000
    assert spark.conf.get(_CLEANUP, None) == held
