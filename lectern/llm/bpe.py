"""Byte-level BPE: ids of whole texts, and texts of ids.

Pre-tokenisation reads no regular expression. Every code point gets a class; the state in which a code
point is read (plain, or inside an English contraction) comes from an associative scan over transition
functions; class, neighbour and state then tell where a slice begins. Equal slices are merged once and
kept in a bounded cache. Slices are code point ranges, so each id can be traced to its place in the text.

Null text is empty text, which has no ids. Repeated rows and extra columns pass through.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from heapq import heapify, heappop, heappush
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.words import give_back, hash_slices, pieces, utf8

OTHER, LETTER, NUMBER, SPACE, BLANK, QUOTE = range(6)

# The white space of the split pattern, and its contractions.
WHITE_SPACE = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")

#: Slices kept with their ids by one task; the cache is emptied when it is full.
CACHE_SLICES = 150_000
#: Bytes of text encoded at once: the more, the more often a slice is met again, at some 70 bytes of memory each.
ENCODE_BYTES = 1 << 19
#: Slices up to this many bytes are merged together as arrays, longer ones with a heap.
SHORT_SLICE = 48

# States of the scan, as read at a code point.
PLAIN, ONE_LEFT, TWO_LEFT, JUST_ENDED = range(4)


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    kinds = defaultdict(lambda: OTHER, dict.fromkeys(("Lu", "Ll", "Lt", "Lm", "Lo"), LETTER) | dict.fromkeys(("Nd", "Nl", "No"), NUMBER))
    count = sys.maxunicode + 1
    table = np.fromiter(map(kinds.__getitem__, map(unicodedata.category, map(chr, range(count)))), np.uint8, count)
    table[list(WHITE_SPACE)] = SPACE
    table[0x20] = BLANK
    table[ord("'")] = QUOTE
    return table


def _function(*to: int) -> int:
    """A function from the four states to states, as one byte."""
    return sum(t << 2 * s for s, t in enumerate(to))


STEP = _function(PLAIN, JUST_ENDED, ONE_LEFT, PLAIN)
OPEN_TWO = _function(ONE_LEFT, ONE_LEFT, ONE_LEFT, ONE_LEFT)
OPEN_THREE = _function(TWO_LEFT, TWO_LEFT, TWO_LEFT, TWO_LEFT)
IDENTITY = _function(*range(4))


@cache
def _then() -> np.ndarray:
    """``_then()[f, g]`` does f, then g."""
    f, g = np.divmod(np.arange(1 << 16), 256)
    out = np.zeros(1 << 16, np.int64)
    for s in range(4):
        out |= (g >> 2 * (f >> 2 * s & 3) & 3) << 2 * s
    return out.astype(np.uint8).reshape(256, 256)


def scan(functions: np.ndarray, width: int = 64) -> np.ndarray:
    """What all functions before each place do together: an exclusive scan by blocks, then over the blocks."""
    n, then = len(functions), _then()
    if n <= 1:
        return np.full(n, IDENTITY, np.uint8)
    blocks = -(-n // width)
    padded = np.full(blocks * width, IDENTITY, np.uint8)
    padded[:n] = functions
    padded = np.ascontiguousarray(padded.reshape(blocks, width).T)
    before = np.empty_like(padded)
    running = np.full(blocks, IDENTITY, np.uint8)
    for i in range(width):
        before[i] = running
        running = then[running, padded[i]]
    if blocks > 1:
        before = then[scan(running, width)[None, :], before]
    return before.T.reshape(-1)[:n]


def boundaries(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Where slices begin in the code points of rows that start at ``rows`` (the last entry is the end)."""
    n = len(points)
    kind = np.full(n + 1, SPACE, np.uint8)
    kind[:n] = classes()[points]
    first = np.zeros(n + 4, bool)  # a row begins here
    first[rows] = True
    first = first[: n + 1] if n else first[:1]
    padded = np.zeros(n + 3, np.uint32)
    padded[:n] = points
    before = np.empty(n, np.uint8)
    before[1:] = kind[: max(n - 1, 0)]
    if n:
        before[0] = SPACE
        before[first[:n]] = SPACE  # another row's end joins nothing
    # A contraction opens at a quote that begins a slice.
    functions = np.full(n, STEP, np.uint8)
    quotes = np.flatnonzero((kind[:n] == QUOTE) & (before != BLANK) & (before != OTHER) & (before != QUOTE))
    if len(quotes):
        ends = rows[np.searchsorted(rows, quotes, side="right")]
        for word in CONTRACTIONS:
            here = quotes + len(word) <= ends
            for j, ch in enumerate(word):
                here &= padded[quotes + j] == ord(ch)
            functions[quotes[here]] = OPEN_TWO if len(word) == 2 else OPEN_THREE
    state = scan(functions) & 3  # what became of PLAIN, in which every text begins
    state[first[:n]] = PLAIN
    white = (kind == SPACE) | (kind == BLANK)
    group = np.where(kind == QUOTE, OTHER, np.where(white, SPACE, kind))
    prior = np.where(before == QUOTE, OTHER, np.where(before == BLANK, SPACE, before))
    starts = group[:n] != prior
    # A run of white space gives up its last one when a word follows: a blank joins the word, others stand alone.
    last = white[:n] & ~white[1:] & ~first[1 : n + 1]
    starts |= last
    joined = np.zeros(n, bool)
    joined[1:] = (kind[: max(n - 1, 0)] == BLANK) & last[: max(n - 1, 0)]
    starts &= ~joined
    starts &= ~((state == ONE_LEFT) | (state == TWO_LEFT))
    starts |= state == JUST_ENDED
    starts |= first[:n]
    return np.flatnonzero(starts)


class Strings:
    """One string of bytes for each id, laid end to end: what any ids make is gathered from them at once."""

    def __init__(self, strings: list[bytes]):
        self.sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def join(self, ids: np.ndarray, rows: np.ndarray) -> tuple[memoryview, list[int]]:
        """The strings of all ``ids`` one after the other, and where each of ``rows``, places in ``ids``, begins."""
        sizes = self.sizes[ids]
        ends = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(sizes, out=ends[1:])
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        at = np.repeat((self.starts[ids] - ends[:-1]).astype(kind), sizes)
        at += np.arange(ends[-1], dtype=kind)
        return memoryview(self.data[at]), ends[rows].tolist()


class Vocabulary:
    """A rank file: tokens by id, and the rank of every two tokens that are one token when joined."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        self.ids = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, i in self.ids.items():
            self.tokens[i] = token
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], np.int64)
        ranks = {
            self.ids[token[:k]] << 32 | self.ids[token[k:]]: i
            for token, i in self.ids.items()
            for k in range(1, len(token))
            if token[:k] in self.ids and token[k:] in self.ids
        }
        self.strings = Strings(self.tokens)
        self.decimal = Strings([f"{i},".encode() for i in range(len(self.tokens))])
        self.keys = np.array(sorted(ranks), np.int64)
        self.values = np.array([ranks[k] for k in self.keys.tolist()], np.int64)
        self.none = len(self.tokens)
        # One slot per hash; keys whose slot is taken are looked up by binary search.
        self.slots = 1 << 21
        order = self._slot(self.keys)
        _, firsts = np.unique(order, return_index=True)
        self.at = np.zeros(self.slots, np.int32)
        self.at[order[firsts]] = firsts
        rest = np.setdiff1d(np.arange(len(self.keys)), firsts)
        self.crowded = np.zeros(self.slots, bool)
        self.crowded[order[rest]] = True
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys >> 32) * 40503 + (keys & 0xFFFFFFFF) * 2654435761) & (self.slots - 1)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``none`` where the two do not join."""
        keys = left << 32 | right
        slot = self._slot(keys)
        at = self.at[slot]
        crowded = np.flatnonzero(self.crowded[slot])
        at[crowded] = np.minimum(np.searchsorted(self.keys, keys[crowded]), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], self.none)

    def rank_one(self, left: int, right: int) -> int | None:
        key = left << 32 | right
        at = min(int(np.searchsorted(self.keys, key)), len(self.keys) - 1)
        return int(self.values[at]) if self.keys[at] == key else None

    def merge_short(self, slices: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of many short slices: each round does the best merge of every slice that has one left."""
        ids = self.bytes[np.frombuffer(b"".join(slices), np.uint8)]
        owner = np.repeat(np.arange(len(slices)), [len(s) for s in slices])
        out: list[tuple[int, ...]] = [()] * len(slices)
        rank = self._pair_ranks(ids, owner)
        while len(ids):
            heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[heads, len(ids)])
            best = np.minimum.reduceat(rank, heads)
            done = best == self.none
            if done.any():
                flat = ids.tolist()
                for o, a, n in zip(owner[heads[done]].tolist(), heads[done].tolist(), sizes[done].tolist(), strict=True):
                    out[o] = tuple(flat[a : a + n])
                keep = ~np.repeat(done, sizes)
                ids, owner, rank = ids[keep], owner[keep], rank[keep]
                heads, best, sizes = None, best[~done], sizes[~done]
                if not len(ids):
                    break
            hits = np.flatnonzero(rank == np.repeat(best, sizes))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]  # the leftmost of each slice
            ids[hits] = rank[hits]
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            moved = np.cumsum(keep) - 1
            ids, owner, rank = ids[keep], owner[keep], rank[keep]
            at = moved[hits]
            touched = np.concatenate((at, at[at > 0] - 1))
            rank[touched] = self._ranks_at(ids, owner, touched)
        return out

    def _pair_ranks(self, ids: np.ndarray, owner: np.ndarray) -> np.ndarray:
        return self._ranks_at(ids, owner, np.arange(len(ids)))

    def _ranks_at(self, ids: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        out = np.full(len(at), self.none, np.int64)
        inner = np.flatnonzero(at < len(ids) - 1)
        inner = inner[owner[at[inner]] == owner[at[inner] + 1]]
        out[inner] = self.rank(ids[at[inner]], ids[at[inner] + 1])
        return out

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice by a heap of its pairs: n log n for any length."""
        ids = [int(self.bytes[b]) for b in piece]
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        pairs = np.array(ids, np.int64)
        first = self.rank(pairs[:-1], pairs[1:]).tolist()
        heap = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(first) if r != self.none]
        heapify(heap)
        while heap:
            r, i, a, b = heappop(heap)
            j = after[i] if ids[i] == a else len(ids)
            if j >= len(ids) or ids[j] != b:
                continue
            ids[i], ids[j] = r, -1
            after[i] = k = after[j]
            if k < len(ids):
                before[k] = i
                if (r := self.rank_one(ids[i], ids[k])) is not None:
                    heappush(heap, (r, i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := self.rank_one(ids[h], ids[i])) is not None:
                heappush(heap, (r, h, ids[h], ids[i]))
        return tuple(x for x in ids if x >= 0)

    def encode_slices(self, slices: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each slice."""
        if len(self.cache) > CACHE_SLICES:
            self.cache.clear()
        known, ids, short = self.cache, self.ids, []
        for s in slices:
            if s not in known:
                if s in ids:
                    known[s] = (ids[s],)
                elif len(s) <= SHORT_SLICE:
                    short.append(s)
                else:
                    known[s] = self.merge_long(s)
        if short:
            known.update(zip(short, self.merge_short(short), strict=True))
        return list(map(known.__getitem__, slices))

    def done(self) -> None:
        """A task is over: what it held goes back, as the worker may serve other work next."""
        self.cache.clear()
        give_back()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


@cache
def vocabulary(path: str) -> Vocabulary:
    """One per Python worker and file."""
    return Vocabulary(path)


class Encoded:
    """Rows of one piece: ``ids[row_ids[r]:row_ids[r + 1]]`` are row r's; ``starts`` their first bytes in the piece."""

    def __init__(self, column: pa.Array, vocab: Vocabulary):
        data, offsets = utf8(column)
        text = data.tobytes()
        points = np.frombuffer(text.decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        at = np.zeros(len(points) + 1, np.int64)
        np.cumsum(width, out=at[1:])
        self.rows = np.searchsorted(at, offsets)
        cuts = at[boundaries(points, self.rows)]
        ends = np.r_[cuts[1:], len(data)] if len(cuts) else cuts
        names = hash_slices(data, cuts, ends)
        _, firsts, self.which = np.unique(names, return_index=True, return_inverse=True)
        spans = zip(cuts[firsts].tolist(), ends[firsts].tolist(), strict=True)
        unique = vocab.encode_slices([text[a:b] for a, b in spans])
        self.counts = np.fromiter(map(len, unique), np.int64, len(unique))
        flat = np.fromiter(chain.from_iterable(unique), np.int64, int(self.counts.sum()))
        heads = np.cumsum(self.counts) - self.counts
        per = self.counts[self.which]
        total = np.zeros(len(per) + 1, np.int64)
        np.cumsum(per, out=total[1:])
        self.ids = flat[np.repeat(heads[self.which] - total[:-1], per) + np.arange(total[-1])]
        self.slice_rows = np.searchsorted(cuts, offsets)
        self.row_ids = total[self.slice_rows]


def _digests(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        sha = hashlib.sha256
        for batch in batches:
            for part in pieces(batch, "text", ENCODE_BYTES):
                done = Encoded(part.column("text"), vocab)
                decimal, begins = vocab.decimal.join(done.ids, done.row_ids)
                decoded, at = vocab.strings.join(done.ids, done.row_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(np.diff(done.row_ids)),
                        pa.array([sha(decimal[a : max(b - 1, a)]).hexdigest() for a, b in pairwise(begins)], pa.string()),  # no last comma
                        pa.array([sha(decoded[a:b]).hexdigest() for a, b in pairwise(at)], pa.string()),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )
        vocab.done()

    return work


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the ids in decimal joined by commas, SHA-256 of the decoded bytes."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(_digests(path), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode(
    docs: DataFrame, path: str, text: str = "text", ids: str = "token_ids", starts: str | None = None, exact: str | None = None
) -> DataFrame:
    """``docs`` with the ids of ``text`` as an array.

    ``starts`` names a column for each id's first UTF-8 byte, ``exact`` one that tells whether the ids, decoded
    where they were made, are the text again. Columns that have these names already are replaced.
    """
    docs = docs.drop(*[c for c in (ids, starts, exact) if c])
    kept = docs.schema.fieldNames()
    schema = T.StructType(docs.schema.fields + [T.StructField(ids, T.ArrayType(T.IntegerType()))])
    if starts:
        schema = schema.add(starts, T.ArrayType(T.LongType()))
    if exact:
        schema = schema.add(exact, T.BooleanType())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        lengths = np.array([len(t) for t in vocab.tokens], np.int64)
        for batch in batches:
            for part in pieces(batch, text, ENCODE_BYTES):
                done = Encoded(part.column(text), vocab)
                offsets = pa.array(done.row_ids, pa.int32())
                columns = [*part.columns, pa.ListArray.from_arrays(offsets, pa.array(done.ids, pa.int32()))]
                if starts:
                    sizes = lengths[done.ids]
                    first = np.cumsum(sizes) - sizes
                    n = np.diff(done.row_ids)
                    base = np.repeat(first[np.minimum(done.row_ids[:-1], max(len(first) - 1, 0))], n) if len(first) else first
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(first - base, pa.int64())))
                if exact:
                    data, offsets = utf8(part.column(text))
                    decoded, at = vocab.strings.join(done.ids, done.row_ids)
                    rows = zip(pairwise(at), pairwise(offsets.tolist()), strict=True)
                    columns.append(pa.array([decoded[a:b] == memoryview(data[x:y]) for (a, b), (x, y) in rows], pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, schema.fieldNames())
        vocab.done()

    return docs.mapInArrow(work, schema)


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of its ids, in place of a column so named.

    Null ids give null; bytes that are no UTF-8 become replacement characters.
    """
    df = df.drop(text).withColumn(ids, F.col(ids).cast("array<int>"))
    kept = df.schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            texts = [None if x is None else vocab.decode(x).decode("utf-8", "replace") for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*kept, text])

    return df.mapInArrow(work, T.StructType(df.schema.fields + [T.StructField(text, T.StringType())]))
