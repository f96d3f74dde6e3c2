import math
from collections import Counter

import numpy as np
import pyarrow as pa

from lectern.llm import importance, words


def grams(text):
    hashes = words.hash_words(*words.utf8(pa.array([text], pa.string())))[0]
    pairs = [words.combine(hashes[i : i + 2], 2)[0] for i in range(len(hashes) - 1)]
    return [int(x) % importance.BUCKETS for x in [*hashes, *pairs]]


def test_equals_plain_models(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    trusted = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1")
    found = {r.doc_id: r for r in importance.resample(docs, trusted).collect()}
    texts = {r.doc_id: grams(r.text) for r in docs.collect()}
    good = {r.doc_id for r in trusted.collect()}
    raw = Counter(g for t in texts.values() for g in t)
    target = Counter(g for d, t in texts.items() if d in good for g in t)
    share = lambda c, g: (c[g] + 1) / (sum(c.values()) + importance.BUCKETS)
    ratio = {g: math.log(share(target, g)) - math.log(share(raw, g)) for g in raw}
    assert len(found) == len(texts)
    for d, t in texts.items():
        assert abs(found[d].log_weight - importance.GRAMS * sum(ratio[g] for g in t) / len(t)) < 1e-6
    order = sorted(found.values(), key=lambda r: r.rank)
    assert [r.rank for r in order] == list(range(1, len(order) + 1))
    assert all(a.key >= b.key for a, b in zip(order, order[1:], strict=False))
    assert [r.selected for r in order] == [i < math.ceil(len(order) / 2) for i in range(len(order))]


def test_noise_is_gumbel(spark):
    noise = np.array([r[0] for r in spark.range(20000).select(importance.gumbel(importance.F.col("id"))).collect()])
    assert abs(noise.mean() - 0.5772) < 0.03 and abs(noise.var() - math.pi**2 / 6) < 0.08


def test_trusted_text_is_preferred(spark):
    rows = [(i, f"good plain words {i % 7} here" if i % 2 else f"junk @@ spam {i % 7} !!") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    chosen = [r.doc_id for r in importance.resample(docs, docs.where("doc_id % 4 = 1")).collect() if r.selected]
    assert len(chosen) == 200 and all(i % 2 for i in chosen)


def test_odd_rows(odd, empty):
    found = importance.resample(odd, odd.where("doc_id = 1")).collect()
    assert sorted(r.rank for r in found) == list(range(1, 13))
    assert sum(r.log_weight is None for r in found) == 3 and all(r.key == -math.inf for r in found if r.log_weight is None)
    assert importance.resample(empty, odd).count() == 0
    assert {r.log_weight for r in importance.resample(odd, empty).collect()} == {None, 0.0}


def test_first_per_key_of_a_hot_key(spark):
    from lectern.llm.sampling import first_per_key

    rows = spark.range(5000).selectExpr("if(id % 10 = 0, id % 3, 7) k", "xxhash64(id) chance", "id")
    found = sorted(map(tuple, first_per_key(rows, "k", ["chance", "id"], 20).collect()))
    everything = sorted(map(tuple, rows.collect()))
    assert found == sorted(r for k in (0, 1, 2, 7) for r in [x for x in everything if x[0] == k][:20])


def test_all_trusted_documents_are_counted(spark):
    docs = spark.range(24_000).selectExpr("id doc_id", "concat('w', id % 7, if(id % 3 = 0, ' plain', ' spam')) text")
    trusted = docs.where("doc_id < 21000").select("doc_id")
    texts = {r.doc_id: grams(r.text) for r in docs.collect()}
    raw = Counter(g for t in texts.values() for g in t)
    target = Counter(g for d, t in texts.items() if d < 21000 for g in t)
    share = lambda c, g, n: (c[g] + 1) / (n + importance.BUCKETS)
    a, b = sum(target.values()), sum(raw.values())
    for bound in ({}, {"broadcast_ids": 1000}):
        found = {r.doc_id: r.log_weight for r in importance.resample(docs, trusted, **bound).collect()}
        for d in range(0, 24_000, 500):
            ratio = [math.log(share(target, g, a) / share(raw, g, b)) for g in texts[d]]
            assert abs(found[d] - importance.GRAMS * sum(ratio) / len(ratio)) < 1e-6
