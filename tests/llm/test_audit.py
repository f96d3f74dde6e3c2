"""The audit against every order applied one filter after the other."""

import re
from collections import Counter
from itertools import permutations
from math import factorial

import pytest

from lectern.llm import audit

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain(docs, labels):
    """Rows as the definition has them: each order applied to lists of documents."""
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    rows = []
    for doc_id, text, part in docs:
        t = text or ""
        words = WORDS.findall(t)
        earlier = doc_id is not None and any(i is not None and i < doc_id and (x or "") == t for i, x, _ in docs)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": earlier,
        }
        rows.append((part or "", doc_id, {n for n, bad in fails.items() if bad}))
    out, sums = {}, Counter()
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[2]]
                left = [r for r in left if f not in r[2]]
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in r[2] for r in own) - len(gone), sum(r[2] == {f} for r in own),
                    sum(r[1] in good for r in gone), sum(r[1] in toxic for r in gone),
                ]
                sums[part, f] += len(gone)
    return {k: (*v, sums[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def found(spark, docs, labels):
    d = spark.createDataFrame(docs, "doc_id long, text string, source string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit(d.selectExpr("*", "1 mask", "'x' part", "2 n", "3 state"), marks).collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[c] for c in (*audit.COUNTS, "shapley")) for r in got}
    assert len(out) == len(got)
    return out


def test_every_order_equals_its_walk(spark):
    long = " ".join(f"w{i}" for i in range(250))
    texts = [long, "Ab # c", "", None, "same same same same", long + " $", "X" * 30, "one two\x0bthree", long, "Ab # c"]
    docs = [(i, texts[i % len(texts)], f"s{i % 3}" if i % 4 else None) for i in range(60)]
    docs += [(None, long, "s1"), (None, "Ab # c", "s1"), (7, "Ab # c", "s1"), (7, "Ab # c", "s1"), (1, "Ab # c", ""), (5, "unique", "alone")]
    labels = [(i, i % 2, (i // 2) % 2) for i in range(0, 60, 3)] + [(3, 1, 1), (3, 0, 0), (None, 1, 1), (6, None, 1)]
    got = found(spark, docs, labels)
    assert got == plain(docs, labels)
    assert len(got) == 600 * len({p or "" for _, _, p in docs})


def test_hot_text_and_empty_table(spark, empty):
    docs = [(i, "copy", "hot") for i in range(500)] + [(i, f"text {i}", "b") for i in range(500, 600)]
    assert found(spark, docs, [(400, 1, 0), (0, 1, 0)]) == plain(docs, [(400, 1, 0), (0, 1, 0)])
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(empty, marks).count() == 0


def test_path_counts():
    lattice = audit.Lattice("ABCD")
    full = (1 << 4) - 1
    assert lattice.reaching[full] == lattice.leaving[0] == factorial(4)
    for state in range(full + 1):
        size = state.bit_count()
        assert lattice.reaching[state] == factorial(size) and lattice.leaving[state] == factorial(4 - size)
    by_level = Counter()
    for state, _, weight in lattice.edges:
        by_level[state.bit_count()] += weight
    assert set(by_level.values()) == {factorial(4)}  # every order uses one edge of each level


def test_two_copy_filters_are_refused(odd, spark):
    with pytest.raises(ValueError):
        audit.audit(odd, spark.createDataFrame([], "doc_id long, quality int, toxic int"), filters={"A": None, "B": None})
