"""Texts whose sets of word shingles have a Jaccard similarity of at least a threshold, found exactly.

Equal sets are one class from the start. A T-occurrence search then runs over the classes. A class of n
shingles can only be similar to one with which it shares at least T = ceil(t n) of them, so all its lists but
the T - 1 longest hold every partner; with a few more lists every partner shares a few. Those short lists are
merged by value in buckets of the shingle space; the lists they give (two or more classes of sizes that fit) meet
at their least class, the list's home, but for classes that are in too few lists to have a partner. A class that shares
at least s lists with every partner stays out of its most crowded homes as long as it leaves fewer than s lists by that:
so a phrase that very many texts hold brings only those together that share little else. In a home the sets of its members form an inverted
index, and DivideSkip runs for every member: short lists are merged and counted, candidates with enough
occurrences are sought in the long lists by binary search, and those that reach the required overlap are links.

List length is told by a fixed-size count of all shingles, which orders them from rare to frequent; any order
is correct, so the count's collisions cost time only. A home with very many members first compares each
with the home's own set. Members linked to it need no comparison with each other, and by the triangle
inequality of Jaccard distance most of them need none with the rest; what remains is searched in blocks,
every two of which meet. So a group of near copies costs work in proportion to its size, and no list, home or
block is ever cut.

Sets are compared by 64-bit hashes of their shingles. Null and empty texts, and texts without words, have
no shingles and link with nothing. Rows with the same doc_id are told apart by their text. Texts of any length are
read whole; an empty table gives no rows; other columns of any name are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.components import components
from lectern.llm.words import SHINGLE, pieces, shingle_sets, utf8
from lectern.scratch import Scratch

#: Similarity in hundredths.
PERCENT = 80
#: Counters of the shingle count, 4 bytes each: what is broadcast.
COUNTER_BITS = 19
COUNTER_SLICES = 32
#: Entries of short lists in one bucket.
BUCKET_ENTRIES = 250_000
#: Short lists that every partner shares: the more, the fewer classes look similar by chance, and the more entries.
MORE_LISTS = 8
#: Sizes compared at once when a list is asked how much its members must share.
SHARE_CELLS = 1 << 20
#: Members of a home or block that are searched together.
HOME_MEMBERS = 1000
#: A class with that many copies, and more than one in ``MANY_CLASSES`` of all documents, is broadcast.
MANY_COPIES, MANY_CLASSES = 1000, 10_000
#: Bits of the filter that tells which documents are in a list, at most.
FILTER_BITS = 1 << 27


def needed(a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Least overlap of sets of a and b elements with the similarity."""
    return (percent * (a + b) + 99 + percent) // (100 + percent)


def prefix(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Short lists of a class of n shingles: at least ``MORE_LISTS`` of them, or all, are shared with every partner."""
    return np.minimum(n, n - (percent * n + 99) // 100 + MORE_LISTS)


def must_share(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Short lists that similar classes of a and b shingles share at least.

    What they share beyond is outside the short lists of one of them, so there is no more of it than the larger has.
    """
    larger = np.maximum(a, b)
    return needed(a, b, percent) - (larger - prefix(larger, percent))


def least_shared(sizes: np.ndarray, percent: int) -> np.ndarray:
    """For each member of a list, by its size, the short lists that it shares at least with any other that fits.

    ``sizes`` is sorted. Members of one size ask for the same, so the work is by distinct sizes.
    """
    kinds, which, counts = np.unique(sizes, return_inverse=True, return_counts=True)
    out = np.empty(len(kinds), np.int64)
    low = np.searchsorted(kinds, (percent * kinds + 99) // 100)
    high = np.searchsorted(kinds, 100 * kinds // percent, side="right")
    at = 0
    while at < len(kinds):
        rows = max(1, SHARE_CELLS // int(high[at:].max() - low[at]))
        to = min(at + rows, len(kinds))
        n, m = kinds[at:to, None], kinds[None, low[at] : high[to - 1]]
        share = must_share(n, m, percent)
        unfit = (100 * np.minimum(n, m) < percent * np.maximum(n, m)) | ((n == m) & (counts[at:to, None] == 1))
        out[at:to] = np.where(unfit, np.iinfo(np.int64).max, share).min(axis=1)
        at = to
    return out[which]


def _set_id(tokens: np.ndarray) -> int:
    """Name of a set: a hash of its sorted elements, as a signed number."""
    if not len(tokens):
        return 0
    x = tokens * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    a = int(np.add.reduce(x)) + len(tokens) * 0xD6E8FEB86659FD93
    b = int(np.bitwise_xor.reduce(x))
    z = ((a ^ (b * 0x94D049BB133111EB)) & 0xFFFFFFFFFFFFFFFF) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    z ^= z >> 30
    return z - (1 << 64) if z >> 63 else z


def _profile(words: int):
    """Per document its set's size and name; per task the shingle counts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNTER_BITS, np.int64)
        waiting: list[np.ndarray] = []
        kind = pa.int64()
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            for part in pieces(batch, "text"):
                sets = shingle_sets(*utf8(part.column("text")), words)
                waiting += sets
                if sum(map(len, waiting)) > 1 << COUNTER_BITS:
                    counts += _count(waiting)
                    waiting = []
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("key"),
                        part.column("mark"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_set_id(s) if len(s) else None for s in sets], pa.int64()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    ["doc_id", "key", "mark", "n_shingles", "set_id", "slice", "counts"],
                )
        counts += _count(waiting)
        slices = counts.astype(np.int32).reshape(COUNTER_SLICES, -1)
        n = COUNTER_SLICES
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, kind), *(pa.nulls(n, pa.int64()) for _ in range(4)), pa.array(range(n), pa.int32())]
            + [pa.array([zlib.compress(s.tobytes(), 1) for s in slices], pa.binary())],
            ["doc_id", "key", "mark", "n_shingles", "set_id", "slice", "counts"],
        )

    return work


def _count(sets: list[np.ndarray]) -> np.ndarray:
    tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    return np.bincount((tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64), minlength=1 << COUNTER_BITS)


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            total[k] = total.get(k, 0) + np.frombuffer(zlib.decompress(c), np.int32).astype(np.int64)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], ["slice", "counts"]
    )


def _short_lists(rarity, words: int, percent: int, buckets: int):
    """Entries (shingle, class, size) of each class's short lists, packed by bucket.

    A shingle has a 32-bit name in its bucket. A class of which two short lists go by one name is told by a negative size.
    """

    def flush(entries: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        tokens, sets, sizes = (np.concatenate(c) for c in zip(*entries, strict=True))
        bucket = (tokens % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        # In a bucket 32 bits tell shingles apart well enough: two that meet in one list by chance cost time only.
        columns = [c[order] for c in ((tokens >> np.uint64(32)).astype(np.uint32), sets, sizes)]
        ends = [*cuts[1:].tolist(), len(bucket)]
        packed = [pa.array([c[a:b].tobytes() for a, b in zip(cuts.tolist(), ends, strict=True)], pa.binary()) for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(bucket[cuts]), *packed], ["bucket", "tokens", "sets", "sizes"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequency = rarity.value
        seen: set[int] = set()
        entries, held = [], 0
        for batch in batches:
            for part in pieces(batch, "text"):
                for tokens in shingle_sets(*utf8(part.column("text")), words):
                    n = len(tokens)
                    if not n or (name := _set_id(tokens)) in seen:
                        continue
                    seen.add(name)
                    k = int(prefix(n, percent))
                    order = np.argsort(frequency[(tokens >> np.uint64(64 - COUNTER_BITS)).astype(np.int64)], kind="stable")
                    short = tokens[order[:k]]
                    names = np.sort((short >> np.uint64(32) << np.uint64(32)) | short % np.uint64(buckets))
                    alike = bool((names[1:] == names[:-1]).any())
                    entries.append((short, np.full(k, name, np.int64), np.full(k, -n if alike else n, np.int32)))
                    held += k
                if held > 1_000_000:
                    yield flush(entries)
                    entries, held = [], 0
        if entries:
            yield flush(entries)

    return work


def _homes(percent: int):
    """(home, member, least, lists) of lists that can hold a link.

    ``least`` is the number of short lists that the member shares at least with every partner that is in the list;
    ``lists`` counts the lists of that home where it is the same. Of a class whose lists cannot be counted, as two go by
    one name, ``least`` is 0.
    """

    def lists(tokens: np.ndarray, sets: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
        # The same class comes from several tasks; lists of one class hold no link.
        order = np.lexsort((sets, tokens))
        tokens, sets, sizes = tokens[order], sets[order], sizes[order]
        fresh = np.r_[True, (tokens[1:] != tokens[:-1]) | (sets[1:] != sets[:-1])]
        tokens, sets, sizes = tokens[fresh], sets[fresh], sizes[fresh]
        alike, sizes = sizes < 0, np.abs(sizes)
        order = np.lexsort((sizes, tokens))
        tokens, sets, sizes, alike = tokens[order], sets[order], sizes[order].astype(np.int64), alike[order]
        # A list falls apart where the next larger class is too large for all before it.
        new = np.r_[True, (tokens[1:] != tokens[:-1]) | (100 * sizes[:-1] < percent * sizes[1:])]
        heads = np.flatnonzero(new)
        lengths = np.diff(np.r_[heads, len(tokens)])
        keep = np.repeat(lengths > 1, lengths)
        least = np.ones(len(tokens), np.int64)
        pairs = heads[lengths == 2]
        least[pairs] = least[pairs + 1] = must_share(sizes[pairs], sizes[pairs + 1], percent)
        some = lengths > 2
        for a, g in zip(heads[some].tolist(), lengths[some].tolist(), strict=True):
            least[a : a + g] = least_shared(sizes[a : a + g], percent)
        least[alike] = 0
        owner = (np.cumsum(new) - 1)[keep]
        sets, least = sets[keep], least[keep]
        if not len(sets):
            return sets, sets, sets, sets
        heads = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        home = np.repeat(np.minimum.reduceat(sets, heads), np.diff(np.r_[heads, len(sets)]))
        order = np.lexsort((least, sets, home))
        home, sets, least = home[order], sets[order], least[order]
        heads = np.flatnonzero(np.r_[True, (home[1:] != home[:-1]) | (sets[1:] != sets[:-1]) | (least[1:] != least[:-1])])
        return home[heads], sets[heads], least[heads], np.diff(np.r_[heads, len(sets)])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[list[bytes]] = [[], [], []]
        for batch in batches:
            for held, name in zip(parts, ("tokens", "sets", "sizes"), strict=True):
                held += batch.column(name).to_pylist()
        if parts[0]:
            kinds = (np.uint32, np.int64, np.int32)
            columns = lists(*(np.frombuffer(b"".join(p), k) for p, k in zip(parts, kinds, strict=True)))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["home", "member", "least", "lists"])

    return work


def _sets_of(chosen, bits: int, words: int):
    """(set_id, tokens) of the documents that the filter lets through."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = chosen.value
        seen: set[int] = set()
        for batch in batches:
            at = batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64) & (bits - 1)
            batch = batch.filter(pa.array((mask[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)))
            for part in pieces(batch, "text") if batch.num_rows else ():
                named = {_set_id(s): s for s in shingle_sets(*utf8(part.column("text")), words) if len(s)}
                new = {k: s for k, s in named.items() if k not in seen}
                seen |= new.keys()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(new), pa.int64()), pa.array([s.tobytes() for s in new.values()], pa.binary())], ["set_id", "tokens"]
                )

    return work


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    return int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0


def divide_skip(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect what the sets' similarity connects; sets are sorted and distinct.

    Members that are connected already are not asked for again.
    """
    count = len(sets)
    if count == 2:
        a, b = sets
        return [(0, 1)] if overlap(a, b) >= needed(len(a), len(b), percent) else []
    order = sorted(range(count), key=lambda i: len(sets[i]))
    sizes = np.array([len(sets[i]) for i in order], np.int64)
    tokens = np.concatenate([sets[i] for i in order])
    members = np.repeat(np.arange(count), sizes)
    # The inverted index: members of each token in order, lists one after the other.
    by_token = np.argsort(tokens, kind="stable")
    _, heads, which = np.unique(tokens[by_token], return_index=True, return_inverse=True)
    entries = members[by_token]
    lengths = np.diff(np.r_[heads, len(tokens)])
    lists = np.empty(len(tokens), np.int64)
    lists[by_token] = which
    composite = lists[by_token] * count + entries  # sorted: a list's members are found by binary search
    ends = np.cumsum(sizes)
    parent = list(range(count))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links = []
    for q in range(1, count):
        n = int(sizes[q])
        low = int(np.searchsorted(sizes[:q], -(-percent * n // 100)))  # smaller sets cannot reach the overlap
        if low == q:
            continue
        least = -(-percent * n // 100)
        mine = lists[ends[q] - n : ends[q]]
        mine = mine[np.argsort(-lengths[mine], kind="stable")]
        longest = int(lengths[mine[0]])
        skip = min(least - 1, int(least / (0.1 * math.log2(longest + 1) + 1)))
        long, short = mine[:skip], mine[skip:]
        spans = lengths[short]
        total = int(spans.sum())
        at = np.repeat(heads[short] - np.cumsum(spans) + spans, spans) + np.arange(total)
        merged = entries[at]
        found = np.bincount(merged[(merged >= low) & (merged < q)], minlength=q)
        hits = np.flatnonzero(found >= least - skip)
        if not len(hits):
            continue
        probes = (long[:, None] * count + hits[None, :]).ravel()
        place = np.minimum(np.searchsorted(composite, probes), len(composite) - 1)
        shared = found[hits] + (composite[place] == probes).reshape(len(long), len(hits)).sum(axis=0)
        for m in hits[shared >= needed(n, sizes[hits], percent)].tolist():
            a, b = root(q), root(m)
            if a != b:
                parent[a] = b
                links.append((order[q], order[m]))
    return links


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of equal keys from a partition that is sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in columns)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def _search(percent: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["home", "first", "second"]):
            names = table.column("member").to_pylist()
            sets = [np.frombuffer(t, np.uint64) for t in table.column("tokens").to_pylist()]
            if links := divide_skip(sets, percent):
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in a], pa.int64()), pa.array([names[i] for i in b], pa.int64())], ["a", "b"])

    return work


def _against_home(percent: int):
    """Similarity of the members of large homes with one of them, ``own``, whose row comes first."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            out = []
            for home, salt, first, member, blob in zip(*(batch.column(c).to_pylist() for c in ("home", "salt", "own", "member", "tokens")), strict=True):
                tokens = np.frombuffer(blob, np.uint64)
                if (home, salt) != last:
                    last, own = (home, salt), tokens
                    continue
                shared = overlap(tokens, own)
                union = len(tokens) + len(own) - shared
                out.append((home, first, member, shared / union, 100 * shared >= percent * union))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.bool_())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], ["home", "own", "member", "similarity", "linked"]
                )

    return work


def _filter_of(keys: DataFrame, bits: int) -> np.ndarray:
    """A bitmap of the keys modulo ``bits``, built in blocks of 32,768 bits."""
    at = keys.select(F.col("key").bitwiseAND(F.lit(bits - 1)).alias("at"))
    rows = at.groupBy(F.expr("at div 32768").alias("block")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(at % 32768 + 1))").alias("bits"))
    mask = np.zeros(max(bits // 8, 4096), np.uint8)
    for r in rows.collect():  # at most FILTER_BITS in all
        mask[r.block * 4096 : r.block * 4096 + 4096] = np.frombuffer(r.bits, np.uint8)
    return mask


def links(docs: DataFrame, profile: DataFrame, scratch: Scratch, words: int, percent: int, members: int) -> DataFrame:
    """(a, b): links between set names that connect all similar sets."""
    spark = docs.sparkSession
    context = spark.sparkContext
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = profile.where("slice is not null").select("slice", "counts").repartition(COUNTER_SLICES, "slice")
    rarity = np.zeros((COUNTER_SLICES, (1 << COUNTER_BITS) // COUNTER_SLICES), np.int64)
    for r in counted.mapInArrow(_sum_counts, "slice int, counts binary").collect():  # fixed size
        rarity[r.slice] = np.frombuffer(r.counts, np.int64)
    frequency = context.broadcast(np.minimum(rarity.reshape(-1), 65535).astype(np.uint16))

    classes = profile.where("set_id is not null").groupBy("set_id").agg(F.min("key").alias("key"), F.first("n_shingles").alias("n"))
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = max(64, -(-total * (100 - percent) // 100 // BUCKET_ENTRIES))
    schema = "bucket int, tokens binary, sets binary, sizes binary"
    entries = docs.select("text").mapInArrow(_short_lists(frequency, words, percent, buckets), schema).repartition(max(parts, buckets // 4), "bucket")
    listed = entries.mapInArrow(_homes(percent), "home long, member long, least long, lists long")
    listed = scratch.write(listed.groupBy("home", "member", "least").agg(F.sum("lists").alias("lists")))
    # A link that asks for t shared lists is seen in t lists that ask for no more.
    asked = listed.groupBy("member", "least").agg(F.sum("lists").alias("lists"))
    so_far = F.sum("lists").over(Window.partitionBy("member").orderBy("least"))
    alive = asked.withColumn("seen", so_far).where(F.col("seen") >= F.col("least")).select("member").distinct()
    homes = listed.join(alive, "member", "left_semi").groupBy("home", "member").agg(F.sum("lists").alias("lists"), F.min("least").alias("least"))
    homes = scratch.write(homes)
    # The shared lists of a link are not all in homes that one of its classes leaves: it leaves too few lists for that.
    crowd = homes.groupBy("home").agg(F.count("*").alias("n")).where("n > 1")
    left_lists = F.sum("lists").over(Window.partitionBy("member").orderBy(F.desc("n"), "home"))
    homes = homes.join(crowd, "home").withColumn("gone", left_lists).where(F.col("gone") >= F.col("least")).select("home", "member")
    homes = scratch.write(homes)
    sized = homes.groupBy("home").agg(F.count("*").alias("n"), F.min("member").alias("own")).where("n > 1")
    rows = scratch.write(homes.join(sized, "home"))

    involved = rows.select(F.col("member").alias("set_id")).distinct()
    keys = scratch.write(classes.join(involved, "set_id", "left_semi").select("set_id", "key"))
    bits = 1 << 15
    while bits < min(FILTER_BITS, 16 * keys.count()):
        bits *= 2
    chosen = context.broadcast(_filter_of(keys, bits))
    passed = docs.select("text", "key").mapInArrow(_sets_of(chosen, bits, words), "set_id long, tokens binary")
    sets = scratch.write(passed.join(keys, "set_id", "left_semi").dropDuplicates(["set_id"]))

    member_sets = sets.withColumnRenamed("set_id", "member")
    small = rows.where(F.col("n") <= members).select("home", F.lit(0).alias("first"), F.lit(0).alias("second"), "member")
    searched = small
    large = rows.where(F.col("n") > members)
    near = None
    if not large.isEmpty():
        salts = F.ceil(F.col("n") / members).cast("int")
        salted = large.where("own <> member").withColumn("salt", F.pmod(F.xxhash64("member"), salts).cast("int")).withColumn("turn", F.lit(1))
        own = large.where("own = member").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).withColumn("turn", F.lit(0))
        both = salted.unionByName(own).join(member_sets, "member").select("home", "salt", "turn", "own", "member", "tokens")
        dealt = both.repartition(parts, "home", "salt").sortWithinPartitions("home", "salt", "turn")
        near = scratch.write(dealt.mapInArrow(_against_home(percent), "home long, own long, member long, similarity double, linked boolean"))
        closest = near.where(~F.col("linked")).groupBy("home").agg(F.max("similarity").alias("closest"))
        # A linked member can be similar to one that is not linked only if their distances from the home allow it.
        slack = 1 - percent / 100 + 1e-9
        rest = near.join(closest, "home").where(~F.col("linked") | (F.col("similarity") <= F.col("closest") + slack))
        left = rest.groupBy("home").agg(F.count("*").alias("n"))
        blocks = F.when(F.col("n") <= members, 1).otherwise(F.ceil(F.col("n") / (members // 2))).cast("int")
        placed = rest.select("home", "member").join(left.withColumn("blocks", blocks), "home")
        placed = placed.withColumn("block", F.pmod(F.xxhash64("member"), "blocks").cast("int"))
        met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        searched = searched.unionByName(met.select("home", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"), "member"))
    meeting = searched.join(member_sets, "member").repartition(parts, "home", "first", "second").sortWithinPartitions("home", "first", "second", "member")
    found = meeting.select("home", "first", "second", "member", "tokens").mapInArrow(_search(percent), "a long, b long")
    return found if near is None else found.union(near.where("linked").select("own", "member"))


def labelled(docs: DataFrame, scratch: Scratch, words: int, percent: int, members: int) -> DataFrame:
    """doc_id, mark, n_shingles, root and component_id of every document.

    ``mark`` is a hash of doc_id and text. ``root`` names the component and is null for a document without shingles.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("key"), F.xxhash64("doc_id", "text").alias("mark"))
    schema = f"doc_id {kind}, key long, mark long, n_shingles long, set_id long, slice int, counts binary"
    profile = scratch.write(rows.mapInArrow(_profile(words), schema))
    known = profile.where("slice is null").select("doc_id", "mark", "n_shingles", "set_id")
    roots = components(links(rows, profile, scratch, words, percent, members), scratch)
    classes = known.where("set_id is not null").groupBy("set_id").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    rooted = classes.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = scratch.write(rooted.join(least, "root").select("set_id", "n", "root", "component_id"))
    # Classes of very many copies are few, however large the input, and go to every task; their documents meet no one
    # in the join that the others take.
    many = max(MANY_COPIES, -(-known.count() // MANY_CLASSES))
    hot = F.broadcast(named.where(F.col("n") >= many).select("set_id", F.col("root").alias("hot_root"), F.col("component_id").alias("hot_id")))
    met = known.join(hot, "set_id", "left").withColumn("set_id", F.when(F.col("hot_root").isNull(), F.col("set_id")))
    met = met.withColumn("set_id", F.coalesce("set_id", "mark"))
    out = met.join(named.where(F.col("n") < many).drop("n"), "set_id", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("hot_id", "component_id"))
    root = F.when(F.col("n_shingles") > 0, F.coalesce("hot_root", "root"))
    return out.select("doc_id", "mark", "n_shingles", root.alias("root"), F.coalesce(own, "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, members: int = HOME_MEMBERS) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links reach, of every document.

    ``docs`` has doc_id and text; it is read three times, and once is staged what is known per document.
    """
    return labelled(docs, Scratch(docs.sparkSession), words, percent, members).select("doc_id", "n_shingles", "component_id")


def keep_one(docs: DataFrame, words: int = SHINGLE, percent: int = PERCENT, members: int = HOME_MEMBERS) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: one with the smallest doc_id.

    Documents without shingles are in no group and stay. Texts are not shuffled but for those documents that a
    filter of fixed size tells may have to go; those are then joined exactly.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    found = scratch.write(labelled(docs, scratch, words, percent, members).where("n_shingles > 0"))
    best = found.groupBy("root").agg(F.min(F.struct("doc_id", "mark"))["mark"].alias("mark"))
    repeated = found.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    gone = scratch.write(found.join(best, "mark", "left_anti").select("mark").distinct())
    suspects = gone.union(repeated).withColumnRenamed("mark", "key")
    bits = 1 << 15
    while bits < min(FILTER_BITS, 16 * found.count()):
        bits *= 2
    chosen = spark.sparkContext.broadcast(_filter_of(suspects, bits))

    @F.pandas_udf("boolean")
    def suspect(mark: pd.Series) -> pd.Series:
        at = mark.to_numpy() & (bits - 1)
        return pd.Series((chosen.value[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool))

    marked = docs.withColumn("__mark", F.xxhash64("doc_id", "text"))
    marked = marked.withColumn("__suspect", suspect("__mark"))
    sure = marked.where(~F.col("__suspect")).drop("__mark", "__suspect")
    left = marked.where("__suspect").join(gone.withColumnRenamed("mark", "__mark"), "__mark", "left_anti")
    left = left.join(found.select(F.col("mark").alias("__grouped")).distinct(), F.col("__mark") == F.col("__grouped"), "left")
    # Repeated rows of a document that stays are one document; those without shingles are not grouped.
    own = F.coalesce(F.col("__grouped"), F.monotonically_increasing_id())
    once = left.withColumn("__own", own).withColumn("__kind", F.col("__grouped").isNull()).dropDuplicates(["__own", "__kind"])
    return sure.unionByName(once.select(*docs.columns))


def near_duplicates_sql(words: int = SHINGLE, percent: int = PERCENT) -> str:
    """The same by a join of all shingles."""
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {words - 1}], ' ') FOR i IN range(1, len(w) - {words - 2})]) END AS s
  FROM split),
classes AS (SELECT min(doc_id) AS c, list_sort(s) AS s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY list_sort(s), len(s)),
tokens AS (SELECT c, n, unnest(s) AS t FROM classes),
pairs AS (
  SELECT a.c AS a, b.c AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.c < b.c
  GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= {percent} * (a.n + b.n - count(*))),
near AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(c, r) AS (SELECT c, c FROM classes UNION SELECT reach.c, near.b FROM reach JOIN near ON reach.r = near.a),
least AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c)
SELECT doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN classes ON list_sort(sets.s) = classes.s LEFT JOIN least USING (c)"""
