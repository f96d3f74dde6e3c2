"""Exact nearest neighbours: for every query vector, the ``k`` base rows at the smallest distance.

Pairs never become rows, and the base stays where it lies. Queries go to the tasks in blocks of ``QUERY_BYTES``, one after the
other; a task compares its base rows with the block in numpy and emits at most ``k`` rows per query; only these
are shuffled, and merged in two steps, first within a share of the tasks, then by query.

Most pairs need not be computed when vectors lie in groups. A few base rows give every query a distance within which
its ``k`` nearest must be, and pivots. The rows of a task are grouped by their nearest pivot, each group with the
radii between which its rows lie; by the triangle inequality a query can leave out a group when its own distance
to the pivot is beyond the radii by more than it still looks for. Cosine distance is searched as the
distance of unit vectors; zero vectors, which are equally far from everything, are always compared.
Where vectors do not lie in groups nothing can be left out, and blocks are compared whole.

Ranking is by distance rounded to ``digits`` and then by the id columns, which makes the result the
same for every partitioning although floating-point sums are not.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lectern.schemas import TOP_K
from lectern.scratch import Scratch

METRICS = ("euclidean", "cosine")
#: Vectors of queries sent to the tasks at a time.
QUERY_BYTES = 16 * 1024 * 1024
#: Base rows that give the first bounds, and how many of them are pivots.
SAMPLE_ROWS = 1024
PIVOTS = 48
#: Base rows grouped at a time.
BASE_ROWS = 8192
#: Groups are compared one by one when they spare at least this share of the pairs.
WORTH = 0.4
#: Shares of the tasks whose results are merged first.
MERGE = 64
_CELLS = 1 << 21


class _Queries:
    """Query block prepared once per task."""

    def __init__(self, vectors: np.ndarray, metric: str):
        self.vectors = _prepare(vectors, metric)
        self.squares = _squares(self.vectors, metric)

    def some(self, places: np.ndarray) -> _Queries:
        part = object.__new__(_Queries)
        part.vectors, part.squares = self.vectors[places], self.squares[places]
        return part


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distance of every two rows, good enough to leave out what is clearly further."""
    squares = np.einsum("ij,ij->i", a, a)[:, None] + np.einsum("ij,ij->i", b, b)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def pick_pivots(rows: np.ndarray, count: int) -> np.ndarray:
    """Rows far from each other: each next one is the furthest from those before."""
    if not len(rows):
        return rows
    picked, near = [0], _apart(rows, rows[:1])[:, 0]
    while len(picked) < min(count, len(rows)) and near.max() > 0:
        picked.append(int(near.argmax()))
        near = np.minimum(near, _apart(rows, rows[picked[-1:]])[:, 0])
    return rows[picked]


class Search:
    """The ``k`` nearest rows seen so far for a block of queries, and what had to be computed for it."""

    def __init__(self, vectors: np.ndarray, sample: np.ndarray, k: int, metric: str, digits: int):
        self.queries, self.k, self.metric, self.digits = _Queries(vectors, metric), k, metric, digits
        sample = _prepare(sample, metric) if len(sample) else np.zeros((0, vectors.shape[1]))
        self.pivots = pick_pivots(sample, PIVOTS)
        self.to_pivot = _apart(self.queries.vectors, self.pivots) if len(sample) else None
        self.zero = metric == "cosine"
        self.within = np.full(len(vectors), np.inf)
        if len(sample) >= k:
            for at in range(0, len(vectors), 4096):
                cut = slice(at, at + 4096)
                self.within[cut] = np.partition(_apart(self.queries.vectors[cut], sample), k - 1, axis=1)[:, k - 1]
            if self.zero and (_lengths(sample) == 0).any():
                self.within[:] = np.inf  # their distance is not that of unit vectors
        if self.zero:
            self.within[_lengths(self.queries.vectors) == 0] = np.inf
        self.best: pd.DataFrame | None = None
        self.pairs = self.all_pairs = 0

    def add(self, vectors: np.ndarray, ids: pd.DataFrame) -> None:
        self.all_pairs += len(vectors) * len(self.queries.vectors)
        rows = _prepare(vectors, self.metric)
        everyone = np.arange(len(self.queries.vectors))
        for places, asking in self._groups(rows) or [(np.arange(len(rows)), everyone)]:
            if not len(asking):
                continue
            self.pairs += len(places) * len(asking)
            found = _best(self.queries.some(asking), rows[places], ids.iloc[places], self.k, self.metric, self.digits)
            found["__q"] = asking[found["__q"].to_numpy()]
            self.best = found if self.best is None else _rank(pd.concat([self.best, found], ignore_index=True), list(ids.columns), self.k)
            self._narrow()

    def _groups(self, rows: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """(places of rows, queries that have to see them) by nearest pivot; None when that would spare little."""
        if self.to_pivot is None or len(rows) < 2 * PIVOTS:
            return None
        far = _apart(rows, self.pivots)
        group = far.argmin(axis=1)
        radius = far[np.arange(len(rows)), group]
        if self.zero:
            group[_lengths(rows) == 0] = -1
        out, work = [], 0
        # Room for rounding, of the distances and of the ranking.
        room = 1e-6 * (1.0 + self.within + far.max()) + 4 * 10.0**-self.digits
        for g in np.unique(group):
            places = np.flatnonzero(group == g)
            if g < 0:
                asking = np.arange(len(self.queries.vectors))
            else:
                reach = self.within + room
                own = self.to_pivot[:, g]
                asking = np.flatnonzero((own - radius[places].max() <= reach) & (radius[places].min() - own <= reach))
            work += len(places) * len(asking)
            out.append((places, asking))
        if work > (1 - WORTH) * len(rows) * len(self.queries.vectors):
            return None
        return sorted(out, key=lambda x: len(x[1]))

    def _narrow(self) -> None:
        """Queries with ``k`` rows look no further than the last of them."""
        by_query = self.best.groupby("__q", sort=False)["distance"]
        last, full = by_query.max(), by_query.size() >= self.k
        last = last[full]
        reach = np.sqrt(np.maximum(2.0 * last.to_numpy(), 0.0)) if self.metric == "cosine" else last.to_numpy()
        at = last.index.to_numpy()
        if self.zero:
            ok = _lengths(self.queries.vectors[at]) > 0
            at, reach = at[ok], reach[ok]
        self.within[at] = np.minimum(self.within[at], reach)


def _lengths(v: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", v, v)


def _prepare(vectors: np.ndarray, metric: str) -> np.ndarray:
    v = np.ascontiguousarray(vectors, dtype=np.float64)
    if metric == "cosine":
        norms = np.sqrt(np.einsum("ij,ij->i", v, v))
        v = v / np.where(norms == 0, 1.0, norms)[:, None]
    return v


def _squares(v: np.ndarray, metric: str) -> np.ndarray:
    """Squared lengths; 1 under cosine, so that a zero vector lies at distance 1 from everything."""
    return np.ones(len(v)) if metric == "cosine" else np.einsum("ij,ij->i", v, v)


def _distance(q: np.ndarray, b: np.ndarray, metric: str, digits: int) -> np.ndarray:
    """Distance of row pairs, summed without the cancellation of the matrix form."""
    if metric == "cosine":
        return np.round(1.0 - np.einsum("ij,ij->i", q, b), digits)
    d = q - b
    return np.round(np.sqrt(np.einsum("ij,ij->i", d, d)), digits)


def _first_copies(vectors: np.ndarray, ids: pd.DataFrame, k: int) -> np.ndarray:
    """Rows that can still rank: of equal vectors only the ``k`` smallest ids can, all others tie behind them."""
    order = ids.reset_index(drop=True).sort_values(list(ids.columns), kind="stable").index.to_numpy()
    flat = np.ascontiguousarray(vectors[order]).view(np.dtype((np.void, vectors.shape[1] * 8))).ravel()
    _, group = np.unique(flat, return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    rank = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.sort(order[by_group[rank < k]])


def _best(queries: _Queries, vectors: np.ndarray, ids: pd.DataFrame, k: int, metric: str, digits: int) -> pd.DataFrame:
    """The ``k`` best base rows of one block for each query: ``__q, distance`` and the id columns.

    The matrix product gives every squared distance up to a known rounding error. Pairs within
    that error of the k-th are computed again exactly, so the choice is exact too.
    """
    base = _prepare(vectors, metric)
    squares = _squares(base, metric)
    names = list(ids.columns)
    parts, step, thinned = [], max(1, _CELLS // max(1, len(base))), False
    at = 0
    while at < len(queries.vectors):
        q = queries.vectors[at : at + step]
        approx = queries.squares[at : at + step, None] + squares[None, :] - 2.0 * (q @ base.T)
        if approx.shape[1] > k:
            kth = np.partition(approx, k - 1, axis=1)[:, k - 1]
            scale = np.sqrt(queries.squares[at : at + step]) + np.sqrt(squares.max())
            error = 4.0 * (base.shape[1] + 4) * np.finfo(np.float64).eps * scale**2
            if metric == "cosine":  # the matrix form is twice the distance
                limit = kth + 2 * error + 4 * 10.0**-digits
            else:
                limit = (np.sqrt(np.maximum(kth + error, 0.0)) + 2 * 10.0**-digits) ** 2 + error
            qi, bi = np.nonzero(approx <= limit[:, None])
            if not thinned and len(qi) > 16 * k * len(q):
                keep = _first_copies(base, ids, k)
                base, squares, ids = base[keep], squares[keep], ids.iloc[keep]
                thinned, step = True, max(1, _CELLS // max(1, len(base)))
                continue
        else:
            qi, bi = (x.ravel() for x in np.indices(approx.shape))
        exact = np.empty(len(qi))
        slab = max(1, _CELLS // base.shape[1])
        for s in range(0, len(qi), slab):
            exact[s : s + slab] = _distance(q[qi[s : s + slab]], base[bi[s : s + slab]], metric, digits)
        found = ids.iloc[bi].reset_index(drop=True)
        found.insert(0, "distance", exact)
        found.insert(0, "__q", qi + at)
        parts.append(_rank(found, names, k))
        at += len(q)
    return pd.concat(parts, ignore_index=True)


def _rank(found: pd.DataFrame, names: Sequence[str], k: int) -> pd.DataFrame:
    ordered = found.sort_values(["__q", "distance", *names], kind="stable")
    return ordered[ordered.groupby("__q", sort=False).cumcount() < k]


def _with_vector(rows: pa.Table | pa.RecordBatch) -> pa.Table | pa.RecordBatch:
    column = rows.column("__v")
    return rows.filter(column.is_valid()) if column.null_count else rows


def _matrix(column: pa.Array) -> np.ndarray:
    """List column without nulls to a matrix; vectors of different length are an error."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.flatten()
    dim = len(values) // max(1, len(column))
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if values.null_count or (lengths != dim).any():
        raise ValueError("vectors must all have the same length and no null elements")
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), dim)


def nearest_neighbors(
    base: DataFrame,
    queries: DataFrame,
    k: int = TOP_K,
    *,
    base_ids: Sequence[str] = ("chunk_id",),
    query_id: str = "question_id",
    base_vector: str = "embedding",
    query_vector: str = "embedding",
    metric: str = "euclidean",
    digits: int = 9,
    query_bytes: int | None = None,
    work: list[DataFrame] | None = None,
) -> DataFrame:
    """``query_id, rank, distance`` and the base id columns, ``k`` rows per query (fewer if the base is smaller).

    Rows with a null vector take no part. ``base_ids`` together identify a base row. ``queries`` and ``base`` are read more than
    once, so vectors should be stored, not computed on the way. ``work``, if given, receives a table of
    ``pairs, all_pairs`` for each block of queries: distances computed, and what all would have been.
    """
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    # Null vectors are left out inside the tasks: a filter here would be pushed below the projection
    # that computes the vector and compute it twice.
    base_rows = base.select(*base_ids, F.col(base_vector).alias("__v"))
    query_rows = queries.select(F.col(query_id), F.col(query_vector).alias("__v"))
    size = query_rows.agg(F.coalesce(F.sum(8 * F.coalesce(F.size("__v"), F.lit(0)) + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // (query_bytes or QUERY_BYTES)))
    sample = _with_vector(base_rows.select("__v").limit(SAMPLE_ROWS).toArrow())
    sample = _matrix(sample.column("__v")) if sample.num_rows else np.zeros((0, 0))
    scratch = Scratch(base.sparkSession) if blocks > 1 else None
    found = []
    for number in range(blocks):
        block = query_rows if blocks == 1 else query_rows.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == number)
        held = _with_vector(block.toArrow())
        rows, sent = _scan(base_rows, query_rows.schema[query_id], held, sample, base_ids, k, metric, digits)
        if work is not None:
            work.append(rows.where("__pairs is not null").select(F.col("__pairs").alias("pairs"), F.col("__all").alias("all_pairs")))
        best = _merge(rows.where("__pairs is null").drop("__pairs", "__all"), query_id, base_ids, k)
        if scratch:
            best = scratch.write(best)  # the next block takes the place of this one in the tasks
            sent.destroy()
        found.append(best)
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out.select(query_id, "rank", "distance", *base_ids)


def _merge(rows: DataFrame, query_id: str, base_ids: Sequence[str], k: int) -> DataFrame:
    """The ``k`` first of each query: first of each share of the tasks, then of all."""
    share = F.pmod(F.spark_partition_id(), F.lit(MERGE)).alias("__share")
    order = ("distance", *base_ids)
    within = F.row_number().over(Window.partitionBy(query_id, "__share").orderBy(*order))
    few = rows.select("*", share).withColumn("__rank", within).where(F.col("__rank") <= k).drop("__rank", "__share")
    overall = F.row_number().over(Window.partitionBy(query_id).orderBy(*order))
    return few.withColumn("rank", overall).where(F.col("rank") <= k)


def _scan(base, id_field, held, sample, base_ids, k, metric, digits):
    counts = [T.StructField(n, T.LongType()) for n in ("__pairs", "__all")]
    schema = T.StructType([id_field, T.StructField("distance", T.DoubleType()), *[base.schema[c] for c in base_ids], *counts])
    ids = held.column(0).to_pandas().to_numpy()
    matrix = _matrix(held.column("__v")) if held.num_rows else np.zeros((0, 0))
    sent = base.sparkSession.sparkContext.broadcast((ids, matrix, sample))
    names, out = list(base_ids), to_arrow_schema(schema)

    def best_of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, matrix, sample = sent.value
        if not len(query_ids):
            return
        search = Search(matrix, sample, k, metric, digits)
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            batch = _with_vector(batch)
            if batch.num_rows:
                waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= BASE_ROWS:
                _feed(search, waiting, names)
                waiting = []
        if waiting:
            _feed(search, waiting, names)
        best = search.best
        if best is not None:
            columns = [pa.array(query_ids[best["__q"].to_numpy()]).cast(out.field(0).type), pa.array(best["distance"].to_numpy())]
            columns += [pa.array(best[c], type=out.field(c).type, from_pandas=True) for c in names]
            columns += [pa.nulls(len(best), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(columns, schema=out)
        nothing = [pa.nulls(1, f.type) for f in list(out)[:-2]]
        yield pa.RecordBatch.from_arrays([*nothing, pa.array([search.pairs]), pa.array([search.all_pairs])], schema=out)

    return base.mapInArrow(best_of_partition, schema), sent


def _feed(search: Search, waiting: list[pa.RecordBatch], names: list[str]) -> None:
    table = pa.Table.from_batches(waiting)
    search.add(_matrix(table.column("__v")), table.select(names).to_pandas())
