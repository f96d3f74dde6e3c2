import math

import numpy as np
import pytest

import compare
from lectern.llm import rabitq

SCHEMA = "vec_id long, embedding array<float>, label int"


def near_vectors(seed, groups, size, dimension=64, spread=0.03):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dimension))
    near = [c + rng.standard_normal((size, dimension)) * spread * rng.random((size, 1)) * 6 for c in centres]
    return np.concatenate([*near, rng.standard_normal((60, dimension))]).astype(np.float32)


def plain(vectors, threshold=0.95):
    unit = [np.array(v, np.float64) for v in vectors]
    n = len(unit)
    cosine = lambda a, b: float(a @ b) / math.sqrt(float(a @ a) * float(b @ b)) if len(a) == len(b) else -1
    linked = [[j for j in range(n) if j != i and cosine(unit[i], unit[j]) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out.append((i, len(linked[i]), min(seen), i == min(seen)))
    return out


@pytest.mark.parametrize("block_rows", [4096, 40])
def test_equals_comparing_all(spark, block_rows):
    vectors = near_vectors(1, 5, 30)
    vectors = np.concatenate([vectors, np.repeat(vectors[:1], 25, axis=0), vectors[3:6] * 4])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    found = rabitq.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3), block_rows=block_rows)
    assert sorted(tuple(r) for r in found.collect()) == plain(vectors)


def test_blocks_that_pivots_hold_apart_do_not_meet(spark, monkeypatch):
    vectors = near_vectors(2, 12, 40)[: 12 * 40]
    kept = []
    meetings = rabitq._meetings
    monkeypatch.setattr(rabitq, "_meetings", lambda blocks, t: kept.append(meetings(blocks, t)) or kept[-1])
    rows = [(i, v.tolist(), 0) for i, v in enumerate(vectors)]
    found = rabitq.near_duplicates(spark.createDataFrame(rows, SCHEMA), block_rows=20)
    assert sorted(tuple(r) for r in found.collect()) == plain(vectors)
    assert sum(len(others) for _, _, others in kept[0]) < len(kept[0]) ** 2 / 2


def test_angles_hold_no_link_apart():
    vectors = near_vectors(4, 6, 50).astype(np.float64)
    seen = rabitq.angles(vectors, vectors[::7])
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    for row, cosine in zip(seen, unit @ unit.T, strict=True):
        assert not (rabitq.apart(row, row, seen, seen, 0.95) & (cosine >= 0.95)).any()


def test_layout_shares_and_splits():
    plan = rabitq.layout([(4, 0, 10), (4, 1, 95), (4, 2, 25), (4, 3, 8), (4, 4, 30), (7, 0, 1)], 30)
    assert plan == [(4, 0, 0, 1), (4, 1, 1, 4), (4, 2, 5, 1), (4, 3, 6, 1), (4, 4, 7, 1), (7, 0, 0, 1)]


def test_screen_equals_comparing_all_codes():
    rng = np.random.default_rng(5)
    a, b = (rabitq.encode(x)[1] for x in np.split(rng.permutation(near_vectors(3, 40, 35)[: 40 * 35]).astype(np.float64), 2))
    most = rabitq.most_unequal(128, 0.95)
    full = lambda x, y: np.array([[sum(int(p ^ q).bit_count() for p, q in zip(r, s, strict=True)) for s in y] for r in x]) <= most
    near = full(a, b)
    rows, others = rabitq.screen(a, b, 0.95, False)
    assert rows.tolist() == np.flatnonzero(near.any(axis=1)).tolist() and others.tolist() == np.flatnonzero(near.any(axis=0)).tolist()
    near = full(a, a) & ~np.eye(len(a), dtype=bool)
    assert rabitq.screen(a, a, 0.95, True)[0].tolist() == np.flatnonzero(near.any(axis=1)).tolist()


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 0), (2, v, 1), (3, [2.0, 4.0, 6.0], 0), (4, None, 0), (5, [], 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 3.0], 0),
        (8, [float("nan"), 1.0, 1.0], 0), (9, [float("inf"), 1.0, 1.0], 0), (10, [1.0, 2.0], 0), (11, [-1.0, -2.0, -3.0], 0), (12, v, 0), (12, v, 0),
        (13, [1e30, 2e30, 3e30], 0), (14, [0.0] * 70 + [1.0], 0),
    ]
    found = sorted(tuple(r) for r in rabitq.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    alike = {1, 2, 3, 12, 13}
    assert found == sorted((i, 5, 1, i == 1) if i in alike else (i, 0, i, True) for i, _, _ in rows)
    assert rabitq.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    query = lambda s, d: rabitq.near_duplicates(s.read.parquet(f"{d}/embeddings.parquet"))
    assert compare.difference(spark, compare.connect(sf), sf, query, rabitq.near_duplicates_sql()) is None


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((4000, 64))
    b = a * 0.8 + rng.standard_normal((4000, 64)) * 0.6
    _, codes, factors = rabitq.encode(a)
    turned, _, _ = rabitq.encode(b)
    signs = np.unpackbits(codes.view(np.uint8), axis=1).astype(float) * 2 - 1
    cosine, error = rabitq.estimate(signs, factors, turned)
    true = np.einsum("ij,ij->i", a, b) / np.sqrt(np.einsum("ij,ij->i", a, a) * np.einsum("ij,ij->i", b, b))
    assert abs((cosine - true).mean()) < 0.005
    assert (np.abs(cosine - true) <= rabitq.ERRORS * error).all()


def test_bits_bound():
    bits = 128
    p = math.acos(0.95) / math.pi
    tail = lambda k: sum(math.comb(bits, i) * p**i * (1 - p) ** (bits - i) for i in range(k + 1, bits + 1))
    most = rabitq.most_unequal(bits, 0.95)
    assert tail(most) <= rabitq.MISS < tail(most - 1)


def test_other_columns_are_not_read(spark):
    rows = [(i, [1.0, float(i // 2)], "x", 5, False) for i in range(4)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>, name string, count int, kept boolean")
    found = sorted(tuple(r) for r in rabitq.near_duplicates(vectors).collect())
    assert found == [(0, 1, 0, True), (1, 1, 0, False), (2, 1, 2, True), (3, 1, 2, False)]
