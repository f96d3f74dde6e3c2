"""Targets against a plain computation; takes by what must hold of every rounding."""

from collections import defaultdict
from fractions import Fraction

import pytest

from lectern.llm import mixing


def plain_targets(sizes):
    """Sources to targets: shared by weight, what is over three times the size shared again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, free = {s: Fraction(0) for s in names}, Fraction(sum(sizes.values())), set(names)
    while left and free:
        unit = left / sum(weight[s] for s in free)
        for s in free:
            target[s] += unit * weight[s]
        left = Fraction(0)
        for s in list(free):
            if target[s] >= 3 * sizes[s]:
                left += target[s] - 3 * sizes[s]
                target[s] = Fraction(3 * sizes[s])
                free.discard(s)
    return target


def check(rows, docs, slack=None):
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    count = lambda text: len((text or "").replace("\x0b", " ").split())
    for _, text, source in docs:
        sizes[source] += count(text)
        largest[source] = max(largest[source], count(text))
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"], r["source"] or "") for r in rows) == sorted((i is not None, i or 0, count(t), s or "") for i, t, s in docs)
    target = plain_targets(sizes)
    for r in rows:
        s = r["source"]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(float(target[s]), rel=1e-12)
        assert r["taken"] <= 3 * r["size"]
        if r["size"]:
            copies = target[s] / sizes[s]
            assert r["taken"] % r["size"] == 0 and abs(Fraction(r["taken"], r["size"]) - copies) < 1
        else:
            assert r["taken"] == 0
        taken[s] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - target[s]) <= (largest[s] if slack is None else slack)
    return taken


def frame(spark, docs, parts=4):
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(parts)
    return rows.selectExpr("*", "7L size", "1 target", "'n' n", "2 rank", "3 node", "4 part")


def words(n):
    return " ".join(["w"] * n)


def test_tree_of_several_levels_keeps_the_targets(spark):
    docs = [(i, words(i % 23 + (400 if i % 97 == 0 else 0)), ["a", "b", "hot", "hot", "hot"][i % 5]) for i in range(3000)]
    docs += [(i, words(9), None) for i in range(3000, 3050)]
    rows = mixing.mix(frame(spark, docs), leaf=8, root=256).collect()
    check(rows, docs, slack=30)
    again = mixing.mix(frame(spark, docs, 7), leaf=8, root=256).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_odd_rows(spark, odd, empty):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd.select("doc_id", "text", "source").collect()]
    check(mixing.mix(odd).collect(), docs)
    assert mixing.mix(empty).count() == 0
    nothing = [(1, None, "a"), (2, "", "b"), (None, " \t", None)]
    assert [r["taken"] for r in mixing.mix(frame(spark, nothing)).collect()] == [0, 0, 0]


def test_capped_sources_share_the_excess(spark):
    docs = [(1, words(1), "a"), (2, words(2), "b"), (3, words(3), "c"), (4, words(500), "d"), (5, words(500), "e")]
    check(mixing.mix(frame(spark, docs)).collect(), docs)


def test_repeated_rows_are_rows_of_their_own(spark):
    docs = [(1, words(10), "a")] * 3000 + [(None, words(4), "b")] * 1000 + [(2, words(7), "b")]
    rows = mixing.mix(frame(spark, docs)).collect()
    check(rows, docs, slack=10)
    assert len({r["taken"] for r in rows if r["doc_id"] == 1}) == 2  # copies differ by one at most


def test_expectations_are_kept(spark):
    """Over many draws each document is taken as often as its share says."""
    import numpy as np

    sizes, shares = [40.0, 11.0, 7.0, 7.0, 3.0, 1.0], [0.3, 0.8, 0.5, 0.25, 0.6, 0.9]
    rng, n = np.random.default_rng(5), 20_000
    total = np.zeros(len(sizes))
    for _ in range(n):
        out, left, part = mixing.pivot(sizes, shares, rng.random(len(sizes)).tolist())
        mass = sum(s * x for s, x in zip(sizes, out)) + (sizes[left] * part if left >= 0 else 0)
        assert mass == pytest.approx(sum(s * p for s, p in zip(sizes, shares)))
        if left >= 0:
            out[left] = int(rng.random() < part)
        total += out
    assert np.abs(total / n - shares).max() < 0.02


def test_many_sources_are_joined_without_a_broadcast(spark, monkeypatch):
    docs = [(i, words(i % 7 + 1), f"s{i % 40}") for i in range(400)]
    plain = sorted(map(str, mixing.mix(frame(spark, docs)).collect()))
    monkeypatch.setattr(mixing, "SOURCE_BYTES", 0)
    assert sorted(map(str, mixing.mix(frame(spark, docs)).collect())) == plain
