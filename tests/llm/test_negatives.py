"""Hard negatives against all scores ranked."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, positives=5, hard=3, low=50, high=95):
    rows = {r[0]: r for r in rows}.values()
    keep = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        keep.append((i, [math.floor(256 * float(np.float32(x))) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = []
    for i, v, label in keep:
        if i % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, w, other in keep if j != i)
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            window = [s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p][:hard]
            out += [(i, j, rank, n, -p, -s) for rank, (s, n, _) in enumerate(window, 1)]
    return sorted(out)


def found(spark, rows, parts=5):
    table = spark.createDataFrame(rows, SCHEMA).repartition(parts).selectExpr("*", "1 score", "2 rank", "'x' vector", "3L window_id", "4 low")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.mine(table, F.col("vec_id") % 50 == 0, label)
    return sorted(tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in got.collect())


def clustered(n, width, seed, labels=10):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, width))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + 0.4 * rng.normal(size=width)
        rows.append((i, (v / np.linalg.norm(v)).tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize(("width", "labels"), [(24, 10), (5, 3), (1, 2)])
def test_equals_all_scores_ranked(spark, width, labels):
    rows = clustered(700, width, width, labels)
    got = found(spark, rows)
    assert got == plain(rows) and (got or width == 1)


def test_small_samples_and_blocks_change_nothing(spark, monkeypatch):
    rows = clustered(600, 16, 3)
    for name, value in (("SAMPLE_ROWS", 20), ("BLOCK_ROWS", 64), ("ANCHORS_AT_ONCE", 7), ("ANCHOR_BYTES", 1500)):
        monkeypatch.setattr(negatives, name, value)
    assert found(spark, rows) == plain(rows)


def test_odd_rows_hot_vectors_and_ties(spark):
    rng = np.random.default_rng(2)
    one = [0.5, -0.25, 0.125, 0.75]
    rows = [(i, one, i % 3) for i in range(300)]  # a third of all rows are one vector: ties everywhere
    rows += [(300 + i, rng.normal(size=4).tolist(), 4) for i in range(300)]
    rows += [(600 + i, [0.0] * 4, 5) for i in range(60)]
    rows += [(700, None, 1), (750, [1.0, None, 0.0, 0.0], 1), (800, [float("nan")] * 4, 1), (850, [float("inf"), 0.0, 0.0, 0.0], 1), (900, one, None), (None, one, 1)]
    rows += [(950, [-x for x in one], 8), (1000, one, 9)]
    assert found(spark, rows) == plain(rows)


def test_vectors_of_other_lengths_and_repeated_ids(spark):
    rows = clustered(150, 6, 8, 3) + [(1000 + i, [0.6, 0.2], i % 3) for i in range(20)] + [(2000, [], 1)]
    table = plain(rows)
    assert found(spark, rows + rows[:40]) == table
    assert found(spark, []) == []


def test_pairs_found_are_exactly_those_that_reach(monkeypatch):
    rng = np.random.default_rng(1)
    for width in (1, 8, 19, 40):
        a, b = np.floor(256 * rng.normal(size=(30, width))), np.floor(256 * rng.normal(size=(200, width)))
        exact = (a @ b.T).astype(np.int64)
        for share in (0.0, 0.5, 0.99):
            least = np.quantile(exact, share, axis=1)
            for few in (0.0, 0.2, 1.0):
                monkeypatch.setattr(negatives, "FEW", few)
                norms = negatives.suffix_norms(a)
                i, j, s = negatives.Index(b, least, norms).reaching(a, norms, least)
                want = exact >= least[:, None]
                got = np.zeros_like(want)
                got[i, j] = True
                assert (got == want).all() and (exact[i, j] == s).all()


def test_lists_leave_out_what_cannot_matter():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(500, 64)) * (0.9 ** np.arange(64))
    anchors = rows[:20] * 1.5
    least = 0.9 * np.einsum("ij,ij->i", anchors, rows[:20])
    index = negatives.Index(rows, least, negatives.suffix_norms(anchors))
    assert sum(index.ends) < 0.7 * 500 * len(index.ends) and len(index.rows) < 500


def test_large_scores():
    a, b = np.array([[2.0**40, 3.0]]), np.array([[2.0**22, 1.0], [2.0**40, 0.0]])
    assert negatives.exact_scores(a[[0, 0]], b).tolist() == [2**62 + 3, 2**63 - 1]
