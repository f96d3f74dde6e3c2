"""Near-duplicate vectors by randomised-rotation binary codes.

Each vector is scaled to length one, padded, turned by a fixed random rotation and kept as the signs of its
coordinates (its code) with the inner product of code and vector (its correction factor). Vectors lie in blocks by
their nearest of ``PIVOTS`` sample vectors, and a block keeps the least and greatest angle of its vectors with each
pivot: by the triangle inequality two blocks whose angles with one pivot are further apart than the threshold's
angle cannot hold a link and do not meet. Of blocks that meet only the codes move (2 bits for each dimension): the number
of unequal code bits bounds the angle of a pair, and vectors with a pair within the bound are then fetched for that pair
of blocks. Such pairs get the unbiased estimate <code, rotated> / factor of their cosine with a confidence bound; those
that may reach the threshold within it are computed again from the vectors in double precision, and only that
decides. Both bounds hold with a chance of error below ``MISS`` per pair.

Equal vectors are one class with a count, so copies cost nothing, however many there are. Links are counted and
joined per pair of blocks; no pair leaves a task. Where vectors do not lie in groups the work is quadratic in the number of
different vectors, at about one machine instruction per 64 code bits and pair.

Vectors that are null, empty, zero, or hold null or non-finite components link with nothing. Vectors of
different dimensions do not link. Rows with the same vec_id and vector count as two. Equal vectors are told by a
128-bit hash.
An empty table gives no rows. Columns beside vec_id and embedding are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.components import components
from lectern.llm.jaccard import grouped
from lectern.llm.sampling import first_per_key
from lectern.scratch import Scratch

THRESHOLD = 0.95
#: Chance that a bound drops a pair that it should keep.
MISS = 1e-9
#: Standard errors of the estimate that a normal error exceeds with about that chance.
ERRORS = 6.0
BLOCK_ROWS = 4096
#: Blocks of one dimension, roughly; more vectors make blocks larger, so that what is kept of all blocks stays small.
BLOCKS = 1024
PIVOTS = 64
#: More than the rounding error of an angle.
ROUNDING = 1e-6
#: Rows of two blocks that are compared at once.
TILE, WIDE = 512, 8192


def code_bits(dimension: int) -> int:
    return 128 * -(-dimension // 64)


@cache
def rotation(dimension: int) -> np.ndarray:
    """The columns of a random rotation of the padded space that the vector's own coordinates use."""
    noise = np.random.default_rng(20240607 + dimension).standard_normal((code_bits(dimension), dimension))
    return np.linalg.qr(noise)[0]


@cache
def most_unequal(bits: int, threshold: float, miss: float = MISS) -> int:
    """Unequal code bits that a pair at the threshold exceeds with a chance below ``miss``."""
    p = math.acos(threshold) / math.pi
    if p <= 0:
        return 0
    logs = [math.lgamma(bits + 1) - math.lgamma(k + 1) - math.lgamma(bits - k + 1) + k * math.log(p) + (bits - k) * math.log1p(-p) for k in range(bits + 1)]
    tail, k = 0.0, bits
    while k > 0 and tail + math.exp(logs[k]) <= miss:
        tail += math.exp(logs[k])
        k -= 1
    return k


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotated unit vectors, codes as rows of 64-bit words, and correction factors."""
    unit = vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]
    turned = unit @ rotation(vectors.shape[1]).T
    signs = turned >= 0
    codes = np.packbits(signs, axis=1).view(np.uint64)
    return turned, codes, np.abs(turned).sum(axis=1) / math.sqrt(turned.shape[1])


def estimate(signs: np.ndarray, factors: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased cosines of coded vectors with rotated ones, row by row, and their standard errors."""
    bits = signs.shape[1]
    cosine = np.einsum("ij,ij->i", signs, turned) / math.sqrt(bits) / factors
    return cosine, np.sqrt(np.maximum(1 - factors**2, 0) / (bits - 1)) / factors


class Block:
    def __init__(self, table: dict):
        self.names = np.frombuffer(table["names"], np.int64)
        self.counts = np.frombuffer(table["counts"], np.int64)
        self.vectors = np.frombuffer(table["vectors"], np.float64).reshape(len(self.names), -1)
        self.codes = np.frombuffer(table["codes"], np.uint64).reshape(len(self.names), -1)
        self.factors = np.frombuffer(table["factors"], np.float64)
        self.norms = np.sqrt(np.einsum("ij,ij->i", self.vectors, self.vectors))

    def signs(self, rows: np.ndarray) -> np.ndarray:
        return np.unpackbits(self.codes[rows].view(np.uint8), axis=1).astype(np.float64) * 2 - 1

    def turned(self, rows: np.ndarray) -> np.ndarray:
        return (self.vectors[rows] / self.norms[rows, None]) @ rotation(self.vectors.shape[1]).T


def unequal_bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Unequal bits of every code of ``a`` with every one of ``b``."""
    kind = np.uint8 if a.shape[1] * 64 < 256 else np.uint32
    out = np.bitwise_count(a[:, 0][:, None] ^ b[None, :, 0]).astype(kind, copy=False)
    for w in range(1, a.shape[1]):
        out += np.bitwise_count(a[:, w][:, None] ^ b[None, :, w])
    return out


def near_codes(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[int, int, np.ndarray]]:
    """Tiles of the pairs of codes that are within the bound: first row of each side, and which pairs; of a block with itself each pair once."""
    most = most_unequal(a.shape[1] * 64, threshold)
    for low in range(0, len(a), TILE):
        for start in range(low if same else 0, len(b), WIDE):
            near = unequal_bits(a[low : low + TILE], b[start : start + WIDE]) <= most
            if same and start == low:
                near = np.triu(near, 1)
            yield low, start, near


def screen(a: np.ndarray, b: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two blocks of codes that are within the bound of a row of the other; of a block with itself, of another row."""
    own, other = np.zeros(len(a), bool), np.zeros(len(b), bool)
    for low, start, near in near_codes(a, b, threshold, same):
        own[low : low + TILE] |= near.any(axis=1)
        other[start : start + WIDE] |= near.any(axis=0)
    if same:
        own |= other
    return np.flatnonzero(own), np.flatnonzero(own if same else other)


def links(a: Block, b: Block, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of ``a`` and ``b`` that link; of a block with itself each pair once."""
    for low, start, near in near_codes(a.codes, b.codes, threshold, same):
        i, j = np.nonzero(near)
        i, j = i + low, j + start
        for k in range(0, len(i), 50_000):
            p, q = i[k : k + 50_000], j[k : k + 50_000]
            rows, at = np.unique(p, return_inverse=True)
            others, to = np.unique(q, return_inverse=True)
            cosine, error = estimate(a.signs(rows)[at], a.factors[p], b.turned(others)[to])
            may = cosine + ERRORS * error >= threshold
            p, q = p[may], q[may]
            exact = np.einsum("ij,ij->i", a.vectors[p], b.vectors[q]) / (a.norms[p] * b.norms[q])
            yield p[exact >= threshold], q[exact >= threshold]


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in pairs:
        a, b = root(x), root(y)
        if a != b:
            parent[a] = b
            kept.append((x, y))
    return kept


def angles(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of each vector with each pivot."""
    length = lambda x: np.sqrt(np.einsum("ij,ij->i", x, x))
    return np.arccos(np.clip((vectors @ pivots.T) / length(vectors)[:, None] / length(pivots), -1.0, 1.0))


def apart(low: np.ndarray, high: np.ndarray, lows: np.ndarray, highs: np.ndarray, threshold: float) -> np.ndarray:
    """Which of many blocks cannot hold a link with one, by the least and greatest angles with each pivot."""
    reach = math.acos(threshold) + ROUNDING
    return ((lows - high > reach) | (low - highs > reach)).any(axis=1)


def layout(sizes: list[tuple[int, int, int]], block_rows: int) -> list[tuple[int, int, int, int]]:
    """(dimension, pivot, first block, blocks) from how many vectors are nearest to each pivot; small groups share a block."""
    out = []
    for dimension in sorted({d for d, _, _ in sizes}):
        own = sorted((pivot, n) for d, pivot, n in sizes if d == dimension)
        rows = max(block_rows, -(-sum(n for _, n in own) // BLOCKS))
        blocks, shared, room = 0, 0, 0
        for pivot, n in own:
            if n < rows:
                if n > room:
                    shared, room, blocks = blocks, rows, blocks + 1
                out.append((dimension, pivot, shared, 1))
                room -= n
            else:
                out.append((dimension, pivot, blocks, -(-n // rows)))
                blocks += -(-n // rows)
    return out


def _home(shared):
    """Each vector with the pivot nearest to it."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            sizes = batch.column("dimension").to_numpy()
            starts = np.cumsum(sizes) - sizes
            flat = lists.flatten().to_numpy()
            home = np.zeros(batch.num_rows, np.int32)
            for dimension in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dimension)
                vectors = flat[starts[rows][:, None] + np.arange(dimension)]
                home[rows] = angles(vectors, shared.value[dimension]).argmin(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home, pa.int32())], [*batch.schema.names, "home"])

    return work


_BLOBS = ["names", "counts", "vectors", "codes", "factors"]


def _pack(shared):
    """One row per block: its vectors, names, counts, codes and factors, and least and greatest angles with the pivots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["dimension", "block"]):
            dimension = table.column("dimension")[0].as_py()
            vectors = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dimension)
            _, codes, factors = encode(vectors)
            names, counts = table.column("name").to_numpy(), table.column("count").to_numpy()
            seen = angles(vectors, shared.value[dimension])
            parts = (names.astype(np.int64), counts.astype(np.int64), vectors, codes, factors, seen.min(axis=0), seen.max(axis=0))
            blobs = [pa.array([x.tobytes()], pa.binary()) for x in parts]
            first = [pa.array([table.column(c)[0].as_py()], pa.int32()) for c in ("dimension", "block")]
            yield pa.RecordBatch.from_arrays(first + blobs, ["dimension", "block", *_BLOBS, "low", "high"])

    return work


def _meetings(blocks: list, threshold: float) -> list[tuple[int, int, list[int]]]:
    """(dimension, block, others): the blocks that each must meet, itself included, by the angles with the pivots."""
    out = []
    for dimension in sorted({r.dimension for r in blocks}):
        own = sorted((r for r in blocks if r.dimension == dimension), key=lambda r: r.block)
        numbers = np.array([r.block for r in own])
        lows, highs = (np.array([np.frombuffer(r[c], np.float64) for r in own]) for c in ("low", "high"))
        for r, low, high in zip(own, lows, highs, strict=True):
            out.append((dimension, r.block, numbers[~apart(low, high, lows, highs, threshold)].tolist()))
    return out


def _screen(threshold: float):
    """For two blocks, by their codes, the rows of each that may link."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["dimension", "first", "second"]):
            rows = sorted(table.to_pylist(), key=lambda r: r["block"])
            codes = [np.frombuffer(r["codes"], np.uint64).reshape(-1, code_bits(r["dimension"]) // 64) for r in rows]
            same = len(rows) == 1
            found = screen(codes[0], codes[-1], threshold, same)
            if not len(found[0]):
                continue
            key = [pa.array([r[c] for r in rows], pa.int32()) for c in ("dimension", "block", "first", "second")]
            picked = pa.array([f.astype(np.int32).tobytes() for f, _ in zip(found, rows, strict=False)], pa.binary())
            yield pa.RecordBatch.from_arrays([*key, picked], ["dimension", "block", "first", "second", "picked"])

    return work


def _fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each block, which comes first, the rows picked for each of its meetings."""
    whole: list[np.ndarray] = []
    for batch in batches:
        for at in range(batch.num_rows):
            r = batch.slice(at, 1).to_pylist()[0]
            if r["picked"] is None:
                names = np.frombuffer(r["names"], np.int64)
                kinds = (np.int64, np.int64, np.float64, np.uint64, np.float64)
                whole = [np.frombuffer(r[c], k).reshape(len(names), -1) for c, k in zip(_BLOBS, kinds, strict=True)]
                continue
            rows = np.frombuffer(r["picked"], np.int32)
            key = [pa.array([r[c]], pa.int32()) for c in ("dimension", "block", "first", "second")]
            blobs = [pa.array([x[rows].tobytes()], pa.binary()) for x in whole]
            yield pa.RecordBatch.from_arrays(key + blobs, ["dimension", "block", "first", "second", *_BLOBS])


def _meet(threshold: float):
    """(a, b, n): links that join what two blocks link, with null n; and for each linked class its links, with null b."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in grouped(batches, ["dimension", "first", "second"]):
            rows = sorted(table.to_pylist(), key=lambda r: r["block"])
            blocks = [Block(r) for r in rows]
            a, b = blocks[0], blocks[-1]
            same = len(blocks) == 1
            count_a, count_b = np.zeros(len(a.names), np.int64), np.zeros(len(b.names), np.int64)
            joined: list[tuple[int, int]] = []
            for i, j in links(a, b, threshold, same):
                np.add.at(count_a, i, b.counts[j])
                np.add.at(count_a if same else count_b, j, a.counts[i])
                joined = _forest(joined + list(zip(a.names[i].tolist(), b.names[j].tolist(), strict=True)))
            names = np.r_[a.names[count_a > 0], b.names[count_b > 0]]
            counts = np.r_[count_a[count_a > 0], count_b[count_b > 0]]
            x, y = zip(*joined, strict=True) if joined else ((), ())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*x, *names.tolist()], pa.int64()),
                    pa.array([*y, *[None] * len(names)], pa.int64()),
                    pa.array([*[None] * len(x), *counts.tolist()], pa.int64()),
                ],
                ["a", "b", "n"],
            )

    return work


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding)."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    e = F.col("embedding").cast("array<double>")
    # Absent and non-finite components leave no finite sum; the largest magnitude keeps squares in range.
    most = F.aggregate(e, F.lit(0.0), lambda s, x: F.greatest(s, F.abs(x)))
    sound = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (most > 0)
    rows = vectors.select("vec_id", F.when(sound, F.transform(e, lambda x: x / most + F.lit(0.0))).alias("vector"))
    hashes = F.struct(F.xxhash64("vector").alias("a"), F.xxhash64(F.lit(1), F.reverse("vector")).alias("b"))
    staged = scratch.write(rows.withColumn("hash", F.when(F.col("vector").isNotNull(), hashes)))
    classes = staged.where("hash is not null").groupBy("hash").agg(
        F.count("*").alias("count"), F.min("vec_id").alias("least"), F.first("vector").alias("vector")
    )
    classes = scratch.write(classes.select("*", F.size("vector").alias("dimension"), F.monotonically_increasing_id().alias("name")))
    pivots: dict[int, list] = {}
    for r in first_per_key(classes.select("dimension", "hash", "vector"), "dimension", ["hash"], PIVOTS).select("dimension", "vector").collect():
        pivots.setdefault(r.dimension, []).append(r.vector)
    shared = spark.sparkContext.broadcast({d: np.array(p, np.float64) for d, p in pivots.items()})
    lean = classes.select("dimension", "name", "count", "vector")
    homes = scratch.write(lean.mapInArrow(_home(shared), "dimension int, name long, count long, vector array<double>, home int"))
    sizes = [tuple(r) for r in homes.groupBy("dimension", "home").count().collect()]  # at most PIVOTS for each dimension
    plan = layout(sizes, block_rows)
    blocks = sum(n for _, _, _, n in plan)
    where = spark.createDataFrame(plan, "dimension int, home int, start int, blocks int")
    number = F.col("start") + F.pmod(F.xxhash64("name"), "blocks").cast("int")
    placed = homes.join(F.broadcast(where), ["dimension", "home"]).select("dimension", number.alias("block"), "name", "count", "vector")
    dealt = placed.repartition(max(parts, blocks // 4), "dimension", "block").sortWithinPartitions("dimension", "block")
    blobs = ", ".join(f"{c} binary" for c in _BLOBS)
    packed = scratch.write(dealt.mapInArrow(_pack(shared), f"dimension int, block int, {blobs}, low binary, high binary"))
    # As many rows as there are blocks: about BLOCKS and PIVOTS for each dimension at most.
    meetings = _meetings(packed.select("dimension", "block", "low", "high").collect(), threshold)
    met = spark.createDataFrame(meetings, "dimension int, block int, others array<int>")
    pair = ["dimension", "first", "second"]
    width = max(parts, min(sum(len(o) for _, _, o in meetings) // 8, 64 * parts))
    coded = packed.select("dimension", "block", "codes").join(F.broadcast(met), ["dimension", "block"])
    coded = coded.select("dimension", "block", "codes", F.explode("others").alias("other"))
    coded = coded.select("dimension", "block", "codes", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    coded = coded.repartition(width, *pair).sortWithinPartitions(*pair)
    key = "dimension int, block int, first int, second int"
    picked = scratch.write(coded.mapInArrow(_screen(threshold), f"{key}, picked binary"))
    both = picked.unionByName(packed.drop("low", "high"), allowMissingColumns=True)
    both = both.repartition(max(parts, blocks // 4), "dimension", "block").sortWithinPartitions("dimension", "block", F.col("first").asc_nulls_first(), "second")
    fetched = both.mapInArrow(_fetch, f"{key}, {blobs}").repartition(width, *pair).sortWithinPartitions(*pair)
    found = scratch.write(fetched.mapInArrow(_meet(threshold), "a long, b long, n long"))
    counts = found.where("n is not null").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"), scratch).withColumnRenamed("node", "name")
    rooted = classes.select("name", "hash", "count", "least").join(roots, "name", "left").withColumn("root", F.coalesce("root", "name"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    linked = F.col("count") - 1 + F.coalesce("n", F.lit(0))
    named = rooted.join(least, "root").join(counts, "name", "left").select("hash", linked.alias("n_links"), "component_id")
    own = F.coalesce("component_id", "vec_id")
    return (
        staged.select("vec_id", "hash")
        .join(named, "hash", "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"), F.col("vec_id").eqNullSafe(own).alias("kept"))
    )


def near_duplicates_sql(threshold: float = THRESHOLD) -> str:
    return f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
near AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= {threshold}),
reach(c, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.c, near.b FROM reach JOIN near ON reach.r = near.a),
least AS (SELECT c, min(r) AS component_id FROM reach GROUP BY c),
counts AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON vec_id = c LEFT JOIN counts ON vec_id = a"""
