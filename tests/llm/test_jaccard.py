import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

import compare
from lectern.llm import jaccard, words
from lectern.llm.components import components
from lectern.scratch import Scratch


def shingles(text, n=5):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    if len(found) < n:
        return frozenset([tuple(found)] if found else [])
    return frozenset(tuple(found[i : i + n]) for i in range(len(found) - n + 1))


def plain(rows, percent=80):
    """(doc_id, n_shingles, component_id) by comparing all."""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least.setdefault(root(i), []).append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in least[root(i)] if x is not None]
        out.append((d, len(sets[i]), min(ids) if ids and sets[i] else d))
    return sorted(out, key=str)


def corpus(seed, copies, edits, size=60):
    """Groups of near copies, a line that most texts share, and texts that share nothing."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    line = [rng.choice(vocabulary) for _ in range(9)]
    rows = []
    for _ in range(4):
        text = [rng.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            near = list(text)
            for _ in range(rng.randrange(edits)):
                near[rng.randrange(len(near))] = rng.choice(vocabulary)
            rows.append(" ".join(near + line * rng.randrange(2)))
    rows += [" ".join(line + [rng.choice(vocabulary) for _ in range(rng.randrange(3, size))]) for _ in range(copies)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("copies", "edits", "members"), [(12, 4, 1000), (40, 5, 10), (30, 9, 8)])
def test_equals_comparing_all(spark, copies, edits, members):
    # Small homes and large ones: those beyond ``members`` take the way by distances and blocks.
    rows = corpus(copies, copies, edits)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = jaccard.near_duplicates(docs, members=members)
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain(rows)


def test_odd_rows(odd, empty, monkeypatch):
    monkeypatch.setattr(jaccard, "MANY_COPIES", 3)  # one class is broadcast, the others are not
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found = sorted((tuple(r) for r in jaccard.near_duplicates(odd).collect()), key=str)
    assert found == plain(rows)
    assert jaccard.near_duplicates(empty).count() == 0


def test_keep_one(spark, odd, empty):
    kept = jaccard.keep_one(odd)
    assert kept.columns == odd.columns
    texts = sorted((str(r.doc_id), str(r.text)) for r in kept.collect())
    everything = sorted({(str(r.doc_id), str(r.text)) for r in odd.collect()} - {("2", "The cat sat on the mat and then it ran")})
    assert texts == everything
    assert jaccard.keep_one(empty).count() == 0
    rows = corpus(3, 10, 3)
    least = {c for _, _, c in plain(rows)}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in jaccard.keep_one(docs).collect()} == least


def test_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    query = lambda s, d: jaccard.near_duplicates(s.read.parquet(f"{d}/documents.parquet"))
    assert compare.difference(spark, compare.connect(sf), sf, query, jaccard.near_duplicates_sql()) is None


def test_divide_skip_links_what_is_similar():
    rng = np.random.default_rng(4)
    for _ in range(20):
        base = rng.integers(0, 300, 80).astype(np.uint64)
        sets = []
        for _ in range(25):
            s = base.copy()
            s[rng.integers(0, 80, rng.integers(0, 25))] = rng.integers(0, 400)
            sets.append(np.unique(np.r_[s, rng.integers(300, 320, 4).astype(np.uint64)]))
        groups = {i: {i} for i in range(25)}

        def join(pairs, groups=groups):
            for i, j in pairs:
                both = groups[i] | groups[j]
                for k in both:
                    groups[k] = both

        join(jaccard.divide_skip(sets, 80))
        found = {frozenset(g) for g in groups.values()}
        groups.update({i: {i} for i in range(25)})
        join((i, j) for i, j in itertools.combinations(range(25), 2) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j])))
        assert found == {frozenset(g) for g in groups.values()}


def test_needed_is_the_least_overlap():
    for a, b in itertools.product(range(1, 60), repeat=2):
        least = next(i for i in range(a + b + 1) if 100 * i >= 80 * (a + b - i))
        assert jaccard.needed(a, b, 80) == least


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, 500 + i) for i in range(1, 40)] + [(900, 901), (901, 900), (7, 7)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark)).collect()}
    assert len({roots[i] for i in range(100, 161)}) == 1
    assert len({roots[i] for i in range(500, 540)}) == 1
    assert roots[900] == roots[901] and len(set(roots.values())) == 3 and 7 not in roots


def test_word_hashes_tell_words():
    texts = ["The cat\tsat", None, "the  CAT sat\n", "", "é É", "x" * (words.PIECE_BYTES + 5) + " y", "the"]
    hashes, rows = words.hash_words(*words.utf8(pa.array(texts)))
    assert np.diff(rows).tolist() == [3, 0, 3, 0, 2, 2, 1]
    assert hashes[:3].tolist() == hashes[3:6].tolist() and hashes[0] == hashes[-1]
    assert len(set(hashes.tolist())) == 7
    sliced = pa.array(texts).slice(2, 3)
    assert words.hash_words(*words.utf8(sliced))[0].tolist() == hashes[3:8].tolist()


def test_sql_sees_the_same_words():
    sql = "SELECT len(regexp_extract_all('a\tb c d', '[^\\x20\\x09-\\x0D]+'))"
    assert compare.connect("/root/testdata/sf0.001").execute(sql).fetchall() == [(3,)]


def test_least_shared_equals_all_pairs(monkeypatch):
    monkeypatch.setattr(jaccard, "SHARE_CELLS", 40)
    rng = np.random.default_rng(8)
    for n in (3, 40, 300):
        sizes = np.sort(rng.integers(1, 60, n))
        share = jaccard.must_share(sizes[:, None], sizes[None, :], 80)
        share[100 * np.minimum.outer(sizes, sizes) < 80 * np.maximum.outer(sizes, sizes)] = np.iinfo(np.int64).max
        np.fill_diagonal(share, np.iinfo(np.int64).max)
        assert jaccard.least_shared(sizes, 80).tolist() == share.min(axis=1).tolist()


def test_similar_sets_share_the_lists_they_must():
    rng = np.random.default_rng(9)
    for _ in range(300):
        base = rng.choice(500, rng.integers(1, 70), replace=False)
        a, b = (np.unique(np.r_[rng.choice(base, rng.integers(len(base) * 9 // 10, len(base)) + 1), rng.integers(500, 520, rng.integers(0, 4))]) for _ in "ab")
        if 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b)):
            short = [s[: jaccard.prefix(len(s), 80)] for s in (a, b)]
            assert len(np.intersect1d(*short)) >= jaccard.must_share(np.int64(len(a)), np.int64(len(b)), 80) >= 1


def phrase_corpus(count, groups):
    """Short texts that share a phrase, a part of them near copies of the text before but for one word at the end."""
    rng = random.Random(count)
    rows = []
    for i in range(count):
        own = [f"u{i}", f"v{i}", f"x{i}"]
        rows.append(" ".join(["please", "click", "here", "to", "read", *own[: rng.randrange(1, 4)]]))
        if i % groups == 0:
            long = [f"y{i}z{j}" for j in range(12)]
            rows += [" ".join(["please", "click", "here", "to", "read", *long]), " ".join(["please", "click", "here", "to", "read", *long, "now"])]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_texts_that_share_a_phrase(spark):
    rows = phrase_corpus(400, 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, jaccard.near_duplicates(docs, members=20).collect()), key=str) == plain(rows)


@pytest.mark.parametrize("name_bits", [0, 6])
def test_shingles_that_go_by_one_name(spark, monkeypatch, name_bits):
    # Shingle hashes whose upper halves are few: lists run together and classes cannot count theirs.
    rows = corpus(5, 15, 5)
    sets = {}

    def narrow(data, offsets, n=5):
        out = []
        for s in words.shingle_sets(data, offsets, n):
            high = (s >> np.uint64(40)) % np.uint64(1 << name_bits)
            out.append(np.unique((high << np.uint64(32)) | (s & np.uint64(0xFFFFFFC0))))
        return out

    entries = [narrow(*words.utf8(pa.array([t])))[0] for _, t in rows]
    for i, s in enumerate(entries):
        sets.setdefault(jaccard._set_id(s), (i, s))

    class Rarity:
        value = np.zeros(1 << jaccard.COUNTER_BITS, np.uint16)

    monkeypatch.setattr(jaccard, "shingle_sets", narrow)
    packed = list(jaccard._short_lists(Rarity, 5, 80, 64)(iter([pa.RecordBatch.from_pydict({"text": [t for _, t in rows]})])))
    listed = {}
    for batch in packed:
        for bucket in set(batch.column("bucket").to_pylist()):
            part = batch.filter(pa.compute.equal(batch.column("bucket"), bucket))
            for found in jaccard._homes(80)(iter([part])):
                for home, member, least, lists in zip(*(c.to_pylist() for c in found.columns), strict=True):
                    listed.setdefault(member, []).append((least, lists, home))
    names = list(sets)
    for a, b in itertools.combinations(names, 2):
        x, y = sets[a][1], sets[b][1]
        if 100 * len(np.intersect1d(x, y)) < 80 * len(np.union1d(x, y)):
            continue
        for one in (a, b):
            asked = sorted(listed[one])
            assert any(sum(n for other, n, _ in asked if other <= least) >= least for least, _, _ in asked)
        assert {h for _, _, h in listed[a]} & {h for _, _, h in listed[b]}
