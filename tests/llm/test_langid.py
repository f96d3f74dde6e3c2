import zlib

import numpy as np
import pyarrow as pa
import pytest

from lectern.llm import langid


def test_gradients_equal_differences():
    net = langid.Network(["a", "b"], hidden=3)
    steps = np.random.default_rng(0).integers(0, 256, (6, 4)).astype(np.int16)
    steps[4:, 0] = langid.PAD
    labels = np.array([0, 1, 1, 0])
    for p, g in zip(net.parameters(), net.gradients(steps, labels)[1], strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old = p[at]
        p[at] = old + 1e-2
        high = net.gradients(steps, labels)[0]
        p[at] = old - 1e-2
        low = net.gradients(steps, labels)[0]
        p[at] = old
        assert abs((high - low) / 2e-2 - g[at]) < 0.01 * abs(g[at]) + 1e-5


def test_windows_hold_every_byte():
    data, offsets = np.arange(1, 11, dtype=np.uint8), np.array([0, 0, 7, 10])
    codes, owner = langid.windows_of(data, offsets, window=4)
    assert owner.tolist() == [1, 1, 2]
    assert codes.tolist() == [[1, 2, 3, 4], [5, 6, 7, 256], [8, 9, 10, 256]]


@pytest.fixture(scope="module")
def found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id < 4000")
    return langid.identify(docs).join(docs, "doc_id").select("doc_id", "held_out", "lang_pred", "score", "lang").collect()


def test_held_out_accuracy(found):
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {d for d in range(4000) if zlib.crc32(str(d).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == r.lang for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found)


def test_windows_are_drawn_from_whole_texts(spark):
    """Windows of a long text come from all of it, and it does not keep other documents out."""
    batch = pa.RecordBatch.from_pydict({"lang": ["a", "b"], "chance": pa.array([-5, 9], pa.int64()), "text": ["é" * 64_000, "short"]})
    drawn = [r for b in langid._draw(10_000)(iter([batch])) for r in b.to_pylist()]
    assert b"".join(r["bytes"] for r in drawn if r["lang"] == "a") == "é".encode() * 64_000
    assert [r["turn"] for r in drawn if r["lang"] == "a"] == list(range(1000))
    assert [r["bytes"] for r in drawn if r["lang"] == "b"] == [b"short"]
    assert len([r for b in langid._draw(7)(iter([batch])) for r in b.to_pylist()]) == 8


def test_marks_at_the_end_of_long_texts_teach(spark):
    rows = [(i, "0123456789 " * 40 + ("xyxy " * 200 if i % 2 else "abba " * 200), "x" if i % 2 else "a") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    told = langid.predict(docs, langid.learn(docs)).collect()
    assert all(r["lang_pred"] == r["lang"] for r in told)


def test_only_the_text_is_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    network = langid.learn(docs.select("doc_id", "text", "lang"))
    a = langid.predict(docs, network).select("doc_id", "lang_pred", "score").collect()
    other = docs.selectExpr("doc_id", "text", "'xx' lang", "'s' source")
    assert sorted(a) == sorted(langid.predict(other, network).select("doc_id", "lang_pred", "score").collect())


def test_odd_rows(odd, empty):
    found = langid.identify(odd).collect()
    assert len(found) == 12
    for r in found:
        if r.doc_id in (3, 4, 5, 9):
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert langid.identify(empty).count() == 0
    assert {r.lang_pred for r in langid.identify(odd.where("lang is null or doc_id = 3")).collect()} == {"und"}


def test_signs_that_are_no_letters_have_no_language(spark):
    network = langid.Network(["a", "b"], hidden=3)
    rows = [(1, "² ½ ① 12 !"), (2, "ª"), (3, None), (4, ""), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["lang_pred"] for r in langid.predict(docs, network).collect()}
    assert {d for d, lang in got.items() if lang == langid.UNKNOWN} == {1, 3, 4}


def test_every_window_teaches(spark, monkeypatch):
    """The lessons after the first one see all windows, of long texts too, in slices that do not depend on how rows lie."""
    monkeypatch.setattr(langid, "LESSON", 64)
    monkeypatch.setattr(langid, "SLICE", 300)
    monkeypatch.setattr(langid, "STEPS", 3)
    taught, plain = [], langid._taught
    monkeypatch.setattr(langid, "_taught", lambda *a: taught.append((plain(*a), a[3])) or taught[-1][0])
    rows = [(i, "ab cd " * (5 + 40 * (i % 7)), "xy"[i % 2]) for i in range(400)]
    rows[5] = (5, "ab cd " * 20_000, "y")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    first = langid.learn(docs.repartition(2)).flat()
    every = sum(-(-len(t) // langid.WINDOW) for _, t, _ in rows)
    assert taught[1] == (every, every // 300) and taught[0][0] < every
    assert np.abs(first - langid.learn(docs.repartition(5)).flat()).max() < 1e-6


def test_batches_share_their_arrays():
    """A batch works in the memory of the one before, whatever its size, and gets what it would get in its own."""
    net, room, rng = langid.Network(["a", "b"]), langid.Room(), np.random.default_rng(3)
    held = None
    for rows in (40, 40, 7, 40):
        steps = rng.integers(0, 257, (16, rows)).astype(np.int16)
        labels = rng.integers(0, 2, rows)
        for mine, own in zip(net.gradients(steps, labels, room=room)[1], net.gradients(steps, labels)[1], strict=True):
            assert np.array_equal(mine, own)
        assert np.array_equal(net.probabilities(steps, room), net.probabilities(steps))
        held = held or dict(room)
        assert all(room[name] is held[name] for name in room)


def test_a_batch_writes_little():
    """What a batch writes and reads again is most of its time: of each byte both layers keep 3 gates and a state, not more."""
    net, room, rng = langid.Network(list("abcd")), langid.Room(), np.random.default_rng(5)
    steps = rng.integers(0, 256, (langid.WINDOW, 64)).astype(np.int16)
    net.gradients(steps, rng.integers(0, 4, 64), tell=False, room=room)
    assert sum(array.nbytes for array in room.values()) / steps.size < 4 * (2 * 4 * langid.HIDDEN + len(net.labels)) * 1.15


def test_rows_add_up():
    """The gradient of a batch is that of its rows, with padding, an odd number of units and steps that fill no whole stretch."""
    net, rng = langid.Network(["a", "b"], hidden=3), np.random.default_rng(4)
    steps = rng.integers(0, 9, (langid.TOGETHER * 2 + 5, 6)).astype(np.int16)
    steps[7:, 2], steps[30:, 5] = langid.PAD, langid.PAD
    labels, real = rng.integers(0, 2, 6), (steps != langid.PAD).sum(axis=0)
    rows = [net.gradients(steps[:, i : i + 1], labels[i : i + 1])[1] for i in range(6)]
    for whole, *parts in zip(net.gradients(steps, labels)[1], *rows, strict=True):
        assert np.allclose(whole, sum(g * share for g, share in zip(parts, real / real.sum(), strict=True)), atol=1e-6)
