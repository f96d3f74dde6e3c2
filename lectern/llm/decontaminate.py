"""Passages of documents that copy, edit or paraphrase benchmark items.

Words are runs of letters, digits and non-ASCII characters, in lower case. A passage is aligned with the item by
Smith-Waterman, and the score as a share of a perfect copy's decides. Of an item of more than ``LONG_ITEM`` words an excerpt
is enough that scores as much as an item of ``LONG_ITEM`` words needs: at a threshold of a half, 25 words in
a row, or more words with edits (50 with every third replaced). Its score is still a share of the whole item. An item of fewer
than ``SHORT_ITEM`` words needs as much as one of that many: 5 words in a row, or all of it where it has no more.
Items of fewer than ``LEAST_ITEM`` words match nothing, as common words would. What is aligned is chosen so that no passage is
missed: a seed is two words of the item that are neighbours or one word apart, found in a document as neighbours or one
word apart. An alignment with M matches and a score of S has at most 2 M - S errors between its matches, so at
most half as many of the M - 1 steps from match to match hold two errors, and at least S / 2 - 1 steps are seeds
at different words of the item. An item's d most common seeds need not be looked up if a passage must
hold d fewer; word counts of the corpus choose d for the least work, and decide nothing else. Where a document holds enough
seeds of an item within the length that a passage may have, the alignment is made. The best passage of a document and item is
found first, then the best ones to its left and right, until none is left: passages of one item do not overlap.

The benchmark goes to all tasks in blocks of at most ``BLOCK_BYTES`` of text; a larger one takes one pass per
block. Documents are never shuffled. A passage that a third of the documents hold costs one alignment
for each of them, and a perfect copy none.

Null and empty documents hold no passage; null, empty and wordless items match nothing. Repeated documents
are found each; equal items are found under each of their ids. Other columns are not read by ``contaminated`` and pass through
``without_contaminated``, whatever their names. Without documents or items there are no passages. A long text is worked
on whole; its cost is linear in its words but for the alignments.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.words import PUNCTUATION, find_words, hash_slices, pieces, utf8

THRESHOLD = 0.5
LONG_ITEM = 50
SHORT_ITEM = 10
LEAST_ITEM = 3
BLOCK_BYTES = 32 << 20
MATCH, MISMATCH, GAP = 2, -1, -1

#: Looking at a word of an item in an alignment, in seeds looked up.
ALIGN_COST = 30

_BITS = 20
_SECOND = np.uint64(0x9FB21C651E98DF25)


def lowered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes and row offsets; code points keep their places."""
    return utf8(pc.utf8_lower(column))


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts, ends, rows = find_words(data, offsets, PUNCTUATION)
    return hash_slices(data, starts, ends), starts, ends, rows


class Items:
    """A block of benchmark items as word hashes."""

    def __init__(self, ids: list, texts: list[str]):
        data, offsets = lowered(pa.array(texts, pa.string()))
        words, _, _, rows = words_of(data, offsets)
        self.ids = ids
        self.words = [words[a:b] for a, b in zip(rows[:-1], rows[1:], strict=True)]
        self.vocabulary = np.unique(words)


def pairs(words: np.ndarray, gap: int) -> np.ndarray:
    """A number for each two words ``gap`` apart; entry i is for the words i and i + gap."""
    return words[:-gap] ^ (words[gap:] * _SECOND) if len(words) > gap else np.zeros(0, np.uint64)


def needed(m: int, threshold: float) -> int:
    """Least alignment score of a passage of an item of ``m`` words: that of one of ``SHORT_ITEM`` to ``LONG_ITEM`` words, or of a whole copy."""
    return min(max(math.ceil(threshold * MATCH * min(max(m, SHORT_ITEM), LONG_ITEM) - 1e-9), 1), MATCH * m)


class Seeds:
    """Pairs of words, neighbours or one word apart, of the items, and how many of them a passage must hold."""

    def __init__(self, items: Items, counts: np.ndarray, total: int, threshold: float = THRESHOLD):
        share = np.maximum(counts, 1) / max(total, 1)
        keys, where = [], []
        self.least = np.zeros(len(items.words), np.int64)
        self.reach = np.zeros(len(items.words), np.int64)
        self.need = np.zeros(len(items.words), np.int64)
        for k, words in enumerate(items.words):
            m = len(words)
            if m < LEAST_ITEM:
                continue
            need = self.need[k] = needed(m, threshold)
            self.reach[k] = max(3 * m - need, m) + 2
            rates = share[np.searchsorted(items.vocabulary, words)]
            rate = 2 * rates[:-1] * (rates[1:] + np.r_[rates[2:], 0.0])
            order = np.argsort(rate, kind="stable")
            left, self.least[k] = _choose(rate[order], max((need + 1) // 2 - 1, 1), int(self.reach[k]), m)
            first = np.sort(order[:left])
            own = np.concatenate([pairs(words, 1)[first], pairs(words, 2)[first[first < m - 2]]])
            keys.append(np.unique(own))
            where.append(np.full(len(keys[-1]), k, np.int64))
        self.pairs = self._table(keys, where)

    @staticmethod
    def _table(keys: list[np.ndarray], where: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        keys = np.concatenate([*keys, np.zeros(0, np.uint64)])
        where = np.concatenate([*where, np.zeros(0, np.int64)])
        order = np.lexsort((where, keys))
        keys, where = keys[order], where[order]
        some = np.zeros(1 << min(max(_BITS, len(keys).bit_length() + 3), 24), bool)
        some[(keys & np.uint64(len(some) - 1)).astype(np.int64)] = True
        return keys, where, some

    def hits(self, words: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """(row, item, place in ``words``), in order, of every seed that lies within one row; each place counts once."""
        out = []
        keys, where, some = self.pairs
        for gap in (1, 2) if len(keys) else ():
            grams = pairs(words, gap)
            at = np.flatnonzero(some[(grams & np.uint64(len(some) - 1)).astype(np.int64)])
            low = np.searchsorted(keys, grams[at], side="left")
            high = np.searchsorted(keys, grams[at], side="right")
            at, low, many = at[high > low], low[high > low], (high - low)[high > low]
            row = np.searchsorted(rows, at, side="right") - 1
            inside = at + gap < rows[row + 1]
            at, low, many, row = at[inside], low[inside], many[inside], row[inside]
            which = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
            out.append(np.stack([np.repeat(row, many), where[which], np.repeat(at, many)], axis=1))
        hits = np.concatenate(out) if out else np.zeros((0, 3), np.int64)
        hits = hits[np.lexsort((hits[:, 2], hits[:, 1], hits[:, 0]))]
        return hits[np.r_[True, (hits[1:] != hits[:-1]).any(axis=1)]] if len(hits) else hits


def _choose(rate: np.ndarray, must: int, reach: int, m: int) -> tuple[int, int]:
    """How many of the item's rarest seeds to look up, and how many of those a passage must hold.

    A passage holds ``must`` seeds; without the d most common it still holds ``must`` - d of them. The d that makes the
    least work at the rates given is taken; any d finds all passages.
    """
    drop = np.arange(must)
    hits = np.cumsum(rate)[len(rate) - 1 - drop]
    least = must - drop
    # Chance that after a hit as many follow within reach: the first term of the Poisson tail bounds its order.
    around = np.minimum(hits * reach, 1.0)
    follow = np.exp((least - 1) * np.log(np.maximum(around, 1e-12)) - np.array([math.lgamma(n) for n in least]))
    best = int(np.argmin(hits * (1 + ALIGN_COST * m * np.minimum(follow, 1.0))))
    return len(rate) - best, int(least[best])


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score, and the end of its first place in the passage."""
    n = len(passage)
    slope = np.arange(n + 1) * -GAP
    before = np.zeros(n + 1, np.int64)
    best, end = 0, 0
    for word in item:
        row = np.zeros(n + 1, np.int64)
        np.maximum(before[:-1] + np.where(passage == word, MATCH, MISMATCH), before[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        # A gap of any length from the left: the best start, less one penalty per step.
        row = np.maximum.accumulate(row + slope) - slope
        top = int(row.argmax())
        if row[top] > best or row[top] == best and top < end:
            best, end = int(row[top]), top
        before = row
    return best, end


def locate(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Score, start and end of the best aligned part of the passage."""
    score, end = align(item, passage)
    _, length = align(item[::-1], passage[:end][::-1])
    return score, end - length, end


def _stretches(places: np.ndarray, least: int, reach: int, low: int, high: int) -> list[tuple[int, int]]:
    """Stretches from ``low`` to ``high`` that hold ``least`` of the places within reach, with what a passage there may cover."""
    if len(places) < least:
        return []
    first, last = places[: len(places) - least + 1], places[least - 1 :]
    near = last - first <= reach
    first, last = np.maximum(last[near] - reach, low), np.minimum(first[near] + reach + 1, high)
    if not len(first):
        return []
    heads = np.flatnonzero(np.r_[True, first[1:] > last[:-1]])
    return list(zip(first[heads].tolist(), last[np.r_[heads[1:] - 1, len(last) - 1]].tolist(), strict=True))


def _copy(item: np.ndarray, words: np.ndarray) -> int:
    """Where ``words`` first hold the item word by word, or -1."""
    for at in np.flatnonzero(words[: max(len(words) - len(item) + 1, 0)] == item[0]).tolist():
        if np.array_equal(words[at : at + len(item)], item):
            return at
    return -1


def passages(items: Items, seeds: Seeds, words: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, int, float, int, int]]:
    """(row, item, score, first word, end word) of the passages that reach the threshold; those of one row and item do not overlap."""
    hits = seeds.hits(words, rows)
    if not len(hits):
        return
    least, reach = seeds.least[hits[:, 1]], seeds.reach[hits[:, 1]]
    last = np.arange(len(hits)) + least - 1
    last[last >= len(hits)] = 0
    near = (hits[last, :2] == hits[:, :2]).all(axis=1) & (last >= np.arange(len(hits))) & (hits[last, 2] - hits[:, 2] <= reach)
    heads = np.flatnonzero(np.r_[True, (hits[1:, :2] != hits[:-1, :2]).any(axis=1)])
    ends = np.r_[heads[1:], len(hits)]
    open_ = np.logical_or.reduceat(near, heads)
    for a, b in zip(heads[open_].tolist(), ends[open_].tolist(), strict=True):
        row, k = int(hits[a, 0]), int(hits[a, 1])
        item = items.words[k]
        for score, start, end in _every(item, words, hits[a:b, 2], int(seeds.least[k]), int(seeds.reach[k]), int(seeds.need[k]), int(rows[row]), int(rows[row + 1])):
            yield row, k, score / (MATCH * len(item)), start, end


def _every(item: np.ndarray, words: np.ndarray, places: np.ndarray, least: int, reach: int, need: int, low: int, high: int) -> Iterator[tuple[int, int, int]]:
    """Score, start and end of the best passage from ``low`` to ``high``, and of the best ones on both sides of it, and so on."""
    parts = [(low, high)]
    while parts:
        low, high = parts.pop()
        inside = places[np.searchsorted(places, low) : np.searchsorted(places, high)]
        for a, b in _stretches(inside, least, reach, low, high):
            at = _copy(item, words[a:b])
            score, start, end = (MATCH * len(item), at, at + len(item)) if at >= 0 else locate(item, words[a:b])
            if score >= need:
                yield score, a + start, a + end
                parts += [(a, a + start), (a + end, b)]


def _count(vocabulary):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        counts = np.zeros(len(known) + 1, np.int64)  # the last counts all words
        some = np.zeros(1 << _BITS, bool)
        some[(known & np.uint64((1 << _BITS) - 1)).astype(np.int64)] = True
        for batch in batches:
            for part in pieces(batch, "text"):
                words = words_of(*lowered(part.column("text")))[0]
                counts[-1] += len(words)
                words = words[some[(words & np.uint64((1 << _BITS) - 1)).astype(np.int64)]]
                at = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
                counts[:-1] += np.bincount(at[known[at] == words], minlength=len(known)) if len(known) else 0
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(counts[used])], ["word", "n"])

    return work


def _find(items, seeds, kind: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, rare = items.value, seeds.value
        names = ["doc_id", "item_id", "score", "start", "end"]
        for batch in batches:
            for part in pieces(batch, "text"):
                data, offsets = lowered(part.column("text"))
                words, starts, ends, rows = words_of(data, offsets)
                found = list(passages(block, rare, words, rows))
                if not found:
                    continue
                # Code points before each place, from the row's first byte on.
                at = lambda row, byte: len(data[offsets[row] : byte].tobytes().decode())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(pa.array([f[0] for f in found])),
                        pa.array([block.ids[f[1]] for f in found], pa.int64() if kind == "bigint" else None),
                        pa.array([f[2] for f in found], pa.float64()),
                        pa.array([at(f[0], starts[f[3]]) for f in found], pa.int64()),
                        pa.array([at(f[0], ends[f[4] - 1]) for f in found], pa.int64()),
                    ],
                    names,
                )

    return work


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[Items]:
    ids, texts, size = [], [], 0
    for r in benchmark.select("item_id", "text").where("text is not null").orderBy("item_id").toLocalIterator():
        if texts and size + len(r.text.encode()) > limit:
            yield Items(ids, texts)
            ids, texts, size = [], [], 0
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text.encode())
    if texts:
        yield Items(ids, texts)


def _shared(rows: DataFrame, benchmark: DataFrame, threshold: float, block_bytes: int) -> Iterator[tuple]:
    """For each block of the benchmark its items and seeds, as broadcasts."""
    context = rows.sparkSession.sparkContext
    for items in _blocks(benchmark, block_bytes):
        vocabulary = context.broadcast(items.vocabulary)
        counted = rows.mapInArrow(_count(vocabulary), "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
        counts = np.zeros(len(items.vocabulary) + 1, np.int64)
        found = counted.toArrow()  # as many rows as the block has words, 16 bytes each
        counts[found.column("word").to_numpy()] = found.column("n").to_numpy()
        yield context.broadcast(items), context.broadcast(Seeds(items, counts[:-1], int(counts[-1]), threshold))


def contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, score (1 is a perfect copy; that of an excerpt may be below ``threshold``), start and end (code points) of the passages found."""
    kind = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {kind}, score double, start long, end long"
    rows = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    for items, seeds in _shared(rows, benchmark, threshold, block_bytes):
        out = out.union(rows.mapInArrow(_find(items, seeds, kind), schema))
    return out


def _drop(items, seeds, column: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, column):
                words, _, _, rows = words_of(*lowered(part.column(column)))
                clean = np.ones(part.num_rows, bool)
                clean[[f[0] for f in passages(items.value, seeds.value, words, rows)]] = False
                yield part.filter(pa.array(clean))

    return work


def without_contaminated(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without those that hold a passage of the benchmark; no row is shuffled."""
    out = docs
    for items, seeds in _shared(docs.select("text"), benchmark, threshold, block_bytes):
        out = out.mapInArrow(_drop(items, seeds, "text"), docs.schema)
    return out
