import random

import numpy as np
import pyarrow as pa

from lectern.llm import decontaminate


def smith_waterman(a, b):
    """Best score, by the textbook's table."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            step = table[i - 1][j - 1] + (decontaminate.MATCH if x == y else decontaminate.MISMATCH)
            table[i][j] = max(0, step, table[i - 1][j] + decontaminate.GAP, table[i][j - 1] + decontaminate.GAP)
    return max(max(r) for r in table), table


def test_alignment_equals_the_table():
    rng = random.Random(1)
    for _ in range(200):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 14))], np.uint64)
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(1, 20))], np.uint64)
        best, table = smith_waterman(a.tolist(), b.tolist())
        score, end = decontaminate.align(a, b)
        assert score == best
        if best:
            assert end == min(j for r in table for j, v in enumerate(r) if v == best)
            score, start, end = decontaminate.locate(a, b)
            assert smith_waterman(a.tolist(), b[start:end].tolist())[0] == best


VOCABULARY = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrs"]


def tables(spark):
    rng = random.Random(7)
    text = lambda n: " ".join(rng.choice(VOCABULARY) for _ in range(n))
    items = [(i, text(rng.randrange(14, 50))) for i in range(20)] + [(90, None), (91, ""), (92, "!!"), (93, text(2))]
    docs, planted = [], {}
    for d in range(300):
        body = text(rng.randrange(20, 400))
        if d % 5 == 0:
            i, item = items[rng.randrange(20)]
            words = item.split()
            if d % 10 == 0:
                for k in range(2, len(words), 7):  # an edit of every seventh word
                    words[k] = rng.choice((rng.choice(VOCABULARY), "", words[k] + " so"))
            cased = " ".join(words)
            cased = cased.upper() if d % 3 == 0 else cased.replace(" ", ", ", 3)
            planted[d] = i
            body = f"{body}. {cased}\n{text(30)}"
        docs.append((d, body))
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), planted


def test_planted_passages_and_no_others(spark):
    docs, items, planted = tables(spark)
    found = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, items).collect() if r.item_id < 90}
    assert set(found) == set(planted.items())
    texts = dict(docs.collect())
    for (d, _), r in found.items():
        assert (r.score == 1.0) == (d % 10 != 0)
        assert texts[d][: r.start].endswith((". ", " ")) or d % 10 == 0
    clean = {r.doc_id for r in decontaminate.without_contaminated(docs, items.where("item_id < 90")).collect()}
    assert clean == set(range(300)) - set(planted)


def test_blocks_of_the_benchmark_change_nothing(spark):
    docs, items, _ = tables(spark)
    whole = sorted(map(tuple, decontaminate.contaminated(docs, items.where("item_id < 90")).select("doc_id", "item_id").collect()))
    parts = decontaminate.contaminated(docs, items.where("item_id < 90"), block_bytes=2000)
    assert sorted(map(tuple, parts.select("doc_id", "item_id").collect())) == whole


def test_odd_rows(spark, odd, empty):
    items = spark.createDataFrame([(1, "sat on the mat and then it"), (2, None), (2, "sat on the mat and then it")], "item_id long, text string")
    found = sorted(map(tuple, decontaminate.contaminated(odd, items).select("doc_id", "item_id", "start", "end").collect()))
    assert found == sorted((d, i, 8, 34) for d in (1, 1, 2) for i in (1, 2))
    assert decontaminate.contaminated(empty, items).count() == 0
    assert decontaminate.contaminated(odd, items.where("false")).count() == 0
    assert decontaminate.without_contaminated(odd, items).count() == 9


def edited(words, kind, rng):
    if kind == "replace":  # every third word: a score of about a half
        return [rng.choice(VOCABULARY) if k % 3 == 2 else w for k, w in enumerate(words)]
    if kind == "insert":  # no two words of the item stay neighbours
        return [x for w in words for x in (w, rng.choice(VOCABULARY))][:-1]
    if kind == "delete":
        return [w for k, w in enumerate(words) if k % 4 != 1]
    if kind == "half":
        return words[: (len(words) + 1) // 2]
    return words


def heavy(rng):
    """Items, and documents that hold heavily edited copies; the first item is in a third of the documents."""
    items = [[rng.choice(VOCABULARY) for _ in range(n)] for n in [20, *range(3, 60, 4)]]
    kinds, docs = ["replace", "insert", "delete", "half", "copy"], []
    for d in range(150):
        item = items[0] if d % 3 == 0 else items[rng.randrange(len(items))]
        around = [[rng.choice(VOCABULARY) for _ in range(rng.randrange(60))] for _ in range(2)]
        docs.append(" ".join(around[0] + edited(item, rng.choice(kinds), rng) + around[1]))
    return [" ".join(i) for i in items], docs


def all_alignments(items, docs, reached):
    """(document, item) -> score of the alignment of the whole texts, where it reaches what is needed."""
    block = decontaminate.Items(list(range(len(items))), items)
    words, _, _, rows = decontaminate.words_of(*decontaminate.lowered(pa.array(docs, pa.string())))
    out = {}
    for d, (a, b) in enumerate(zip(rows[:-1], rows[1:], strict=True)):
        for k, item in enumerate(block.words):
            score = decontaminate.align(item, words[a:b])[0]
            if reached(score, len(item)):
                out[d, k] = score / (decontaminate.MATCH * len(item))
    return out


def enough(score, m):
    """Half of a copy of an item of 10 to 50 words, or all of a shorter one."""
    return m >= 3 and score >= min(min(max(m, 10), 50), 2 * m)


def best(found):
    """(document, item) -> score of its best passage."""
    out = {}
    for d, k, score in found:
        out[d, k] = max(score, out.get((d, k), 0))
    return out


def test_no_passage_of_all_alignments_is_missed(spark):
    items, docs = heavy(random.Random(5))
    expected = all_alignments(items, docs, enough)
    # The item of three words (1) counts only whole, and no document holds it so.
    assert len(expected) > 100 and {k for _, k in expected} == set(range(len(items))) - {1}
    given = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = best((r.doc_id, r.item_id, r.score) for r in decontaminate.contaminated(given, benchmark).collect())
    assert found == expected
    clean = {r.doc_id for r in decontaminate.without_contaminated(given, benchmark).collect()}
    assert clean == set(range(len(docs))) - {d for d, _ in expected}


def test_size_of_the_corpus_and_counts_hide_nothing():
    items, docs = heavy(random.Random(6))
    expected = all_alignments(items, docs, enough)
    block = decontaminate.Items(list(range(len(items))), items)
    words, _, _, rows = decontaminate.words_of(*decontaminate.lowered(pa.array(docs, pa.string())))
    counts = np.array([(words == w).sum() for w in block.vocabulary])
    for given, total in ((counts, len(words)), (counts * 10**7, len(words) * 10**7), (counts, len(words) * 10**7), (counts * 0, 1)):
        seeds = decontaminate.Seeds(block, given, total)
        assert best((r, k, s) for r, k, s, _, _ in decontaminate.passages(block, seeds, words, rows)) == expected


def all_passages(item, words, low, high):
    """The best alignment of all words, then those left and right of it."""
    if low >= high:
        return []
    score, start, end = decontaminate.locate(item, words[low:high])
    if not enough(score, len(item)):
        return []
    rest = all_passages(item, words, low, low + start) + all_passages(item, words, low + end, high)
    return [(score / (decontaminate.MATCH * len(item)), low + start, low + end), *rest]


def test_every_passage_is_found():
    rng = random.Random(11)
    items = [[rng.choice(VOCABULARY) for _ in range(n)] for n in (3, 5, 9, 12, 20, 45, 80)]
    docs = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(6)):
            item = rng.choice(items[:4] if rng.random() < 0.3 else items[3:5])
            parts += edited(item, rng.choice(["replace", "insert", "delete", "half", "copy", "copy"]), rng)
            parts += [rng.choice(VOCABULARY) for _ in range(rng.choice((0, 1, 8, 60)))]
        docs.append(" ".join(parts))
    block = decontaminate.Items(list(range(len(items))), [" ".join(i) for i in items])
    words, _, _, rows = decontaminate.words_of(*decontaminate.lowered(pa.array(docs, pa.string())))
    counts = np.array([(words == w).sum() for w in block.vocabulary])
    found = sorted(decontaminate.passages(block, decontaminate.Seeds(block, counts, len(words)), words, rows))
    expected = [(d, k, *p) for d in range(len(docs)) for k, item in enumerate(block.words) for p in all_passages(item, words, rows[d], rows[d + 1])]
    assert found == sorted(expected)
    assert max(sum(f[:2] == (d, k) for f in found) for d, k, *_ in found) >= 4


def test_copies_in_one_document_have_a_row_each(spark):
    item = "the quick brown fox jumps over a lazy dog while the owner reads his morning paper"
    text = f"{item}. and then, some other words; {item.upper()} {item}"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    found = sorted((r.start, r.end, r.score) for r in decontaminate.contaminated(docs, items).collect())
    assert [text[a:b].lower() for a, b, _ in found] == [item] * 3 and {s for *_, s in found} == {1.0}


def test_short_items_do_not_match_common_words(spark):
    rng = random.Random(3)
    text = lambda n: [rng.choice(VOCABULARY) for _ in range(n)]
    items = [text(n) for n in (1, 2, 3, 4, 5, 6, 7, 8, 9)]
    docs, planted = [], set()
    for d in range(400):
        body = text(200)
        k = d % len(items)
        if d % 4 == 0:  # a whole copy
            body[50:50] = items[k]
            planted |= {(d, k)} if k >= 2 else set()
        elif d % 4 == 1:  # two neighbours, or the first word: no evidence
            body[50:50] = items[k][: 2 if k >= 2 else 1]
        docs.append((d, " ".join(body)))
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == planted


def test_excerpts_of_long_items(spark):
    rng = random.Random(8)
    text = lambda n: [rng.choice(VOCABULARY) for _ in range(n)]
    items = [text(59), text(300), text(50), text(400)]
    parts = [
        (0, items[0][10:39]),  # 29 of 59 words
        (1, items[1][100:240]),  # 140 of 300
        (1, items[1][30:55]),
        (3, items[3][-25:]),
        (3, edited(items[3][50:130], "replace", rng)),
        (2, items[2][25:]),
        (None, items[2][5:28]),  # 23 of 50: too little
        (None, items[1][70:92]),  # 22 of 300: too little
        (None, text(30)),
    ]
    docs = [" ".join([*text(40), "||", *part, "||", *text(40)]) for _, part in parts]
    least = decontaminate.THRESHOLD * decontaminate.MATCH
    expected = all_alignments([" ".join(i) for i in items], docs, lambda score, m: score >= least * min(m, decontaminate.LONG_ITEM))
    assert set(expected) == {(d, k) for d, (k, _) in enumerate(parts) if k is not None}
    given = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    benchmark = spark.createDataFrame([(k, " ".join(i)) for k, i in enumerate(items)], "item_id long, text string")
    assert {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(given, benchmark).collect()} == expected
    assert {r.doc_id for r in decontaminate.without_contaminated(given, benchmark).collect()} == {6, 7, 8}
