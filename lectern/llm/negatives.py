"""Hard negatives of anchors: rows of other labels that score a little under the anchor's own positives.

A search asks, for each anchor, for the best rows above a threshold. Thresholds start high, taken from the scores of a small
sample of rows, and are lowered for the anchors whose windows did not fill; a row of the sample is a row of the table, so at
its k-th score a window must fill, or else it is searched down to its floor. Every search is a threshold join over all
rows, in the manner of L2AP:

* Dimensions are put in the order of their weight in the sample. A block of rows becomes an inverted index, a list of
  values per dimension. The list of a dimension leaves out the rows whose norm from there on, times the greatest such
  norm of the anchors in units of their thresholds, is under 1: no score can reach a threshold by what is left out.
* Scores are added up list by list. After each few lists, pairs whose sum plus the product of the remaining norms is under the
  threshold are dropped; when few are left they go on as pairs, to their exact score.

Norms only preselect, with room for rounding; what comes out are integer products of whole vectors. The rows stay where they are. Anchors are
a stated share of the rows and go to the tasks in blocks of ``ANCHOR_BYTES``, one block at a time. A task sends at most
k rows per window. Of equal vectors of one label only the first few ids of a block take part, as no others can be among the first.

Rows without an id, label or vector, or with a null, NaN or infinite component take no part. Rows with one id are one
row, the first by label and vector. Vectors of fewer components than others count as if zeros followed.
Components are floor(scale * x) as doubles, at most 2**62 from zero; a score beyond 64-bit integers is the last of them. Other columns are not read, whatever their names. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lectern.scratch import Scratch

SCALE = 256
#: Vectors of anchors sent to the tasks at a time.
ANCHOR_BYTES = 16 * 1024 * 1024
#: Rows of the sample that starting thresholds are taken from, and their bytes.
SAMPLE_ROWS = 2048
SAMPLE_BYTES = 8 * 1024 * 1024
#: Rows of one inverted index, and anchors matched with it at a time.
BLOCK_ROWS = 4096
ANCHORS_AT_ONCE = 256
#: Dimensions between two looks at what can be dropped.
STEP = 8
#: Pairs are followed one by one when no more than this share of them is left.
FEW = 1 / 32
_EXACT_BELOW = float(1 << 53)
_ROUNDING = 1e-9
_MOST = (1 << 63) - 1


def vectors(table: DataFrame, vec_id: str = "vec_id", label: str = "label", embedding: str = "embedding") -> DataFrame:
    """vec_id, label, vector (doubles) of the rows that take part, one per id."""
    rows = table.select(F.col(vec_id).alias("vec_id"), F.col(label).alias("label"), F.col(embedding).cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null and label is not null and vector is not null")
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is greater than infinity
    rows = rows.where(finite)
    repeated = rows.groupBy("vec_id").count().where("count > 1").select("vec_id")
    if repeated.isEmpty():
        return rows
    one = rows.join(repeated, "vec_id", "left_semi").groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("first"))
    return rows.join(repeated, "vec_id", "left_anti").unionByName(one.select("vec_id", "first.*"))


@dataclass
class Space:
    """Order of dimensions and the sample of rows, as every task gets them."""

    order: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray


def matrix(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """Lists to floor(scale * x), short ones filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore"):
        values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    values = np.clip(values, -(2.0**62), 2.0**62)
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width))
    owner = np.repeat(np.arange(len(column)), lengths)
    out[owner, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out


def suffix_norms(rows: np.ndarray, step: int = STEP) -> np.ndarray:
    """Norm of each row from dimension 0, step, 2 * step and so on, and 0; a little more, for rounding."""
    squares = np.add.reduceat(rows * rows, np.arange(0, rows.shape[1], step), axis=1) if rows.shape[1] else np.zeros((len(rows), 0))
    norms = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
    norms = np.concatenate([norms, np.zeros((len(rows), 1))], axis=1)
    return norms + _ROUNDING * norms[:, :1]


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner product of row pairs as integers."""
    if max(np.abs(a).max(initial=0), 1) * max(np.abs(b).max(initial=0), 1) * max(a.shape[1], 1) < _EXACT_BELOW:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    whole = (sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True))
    return np.array([min(max(x, -_MOST), _MOST) for x in whole], np.int64)


class Index:
    """Inverted index of a block of rows, for anchors that must reach their thresholds.

    The lists are columns of a matrix whose rows are sorted by how many steps of dimensions they are listed in, so
    the list of a step is its first rows.
    """

    def __init__(self, rows: np.ndarray, least: np.ndarray, anchor_norms: np.ndarray):
        self.norms = suffix_norms(rows)
        steps = self.norms.shape[1] - 1
        if (least > 0).all():
            reach = (anchor_norms / least[:, None]).max(axis=0)
            spared = self.norms * reach[None, :] < 1.0 - _ROUNDING
            spared[:, steps] = True
            listed = spared.argmax(axis=1)
        else:  # an anchor that takes any score
            listed = np.full(len(rows), steps)
        self.place = np.argsort(-listed, kind="stable")
        self.place = self.place[: int((listed > 0).sum())] if (least > 0).all() else self.place
        self.rows, self.norms = rows[self.place], self.norms[self.place]
        self.ends = [int((listed > s).sum()) for s in range(steps)]

    def reaching(self, anchors: np.ndarray, norms: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of every pair that reaches the anchor's threshold."""
        width, at = anchors.shape[1], 0
        sums = np.zeros((len(anchors), len(self.rows)))
        alive = np.ones(sums.shape, bool)
        # Scores are whole numbers; large ones are rounded in the sums.
        bound = least - 0.5 - 1e-12 * norms[:, 0] * self.norms[:, 0].max(initial=0.0)
        for s, end in enumerate(self.ends):
            if not end:
                break
            to = min(at + STEP, width)
            sums[:, :end] += anchors[:, at:to] @ self.rows[:end, at:to].T
            at = to
            # A row whose lists end here keeps this bound: what its lists leave out is in the remaining norm.
            alive[:, :end] &= sums[:, :end] + norms[:, s + 1, None] * self.norms[None, :end, s + 1] >= bound[:, None]
            if s + 1 < len(self.ends) and np.count_nonzero(alive) <= FEW * alive.size:
                break
        ai, bi = np.nonzero(alive)
        if not len(ai):
            return ai, bi, np.zeros(0, np.int64)
        return self._follow(anchors, norms, least, bound, ai, bi, sums[ai, bi], at)

    def _follow(self, anchors, norms, least, bound, ai, bi, part, at):
        """Pairs to their exact score, dropped as soon as they cannot reach the threshold."""
        width = anchors.shape[1]
        listed = np.searchsorted(-np.array(self.ends), -bi, side="left")  # steps whose list holds the row
        done = np.minimum(listed * STEP, at)  # dimensions that are in the sum
        scores = np.zeros(len(ai), np.int64)
        slab = max(1, (1 << 21) // max(1, width))
        keep = []
        for low in range(0, len(ai), slab):
            a, b, sums, have = ai[low : low + slab], bi[low : low + slab], part[low : low + slab], done[low : low + slab]
            live = np.arange(len(a))
            for s in range(-(-width // STEP)):
                late = have[live] <= s * STEP  # the step is not in the sum yet
                if late.any():
                    p = live[late]
                    cut = slice(s * STEP, min((s + 1) * STEP, width))
                    sums[p] += np.einsum("ij,ij->i", anchors[a[p], cut], self.rows[b[p], cut])
                    rest = norms[a[live], s + 1] * self.norms[b[live], s + 1]
                    live = live[~late | (sums[live] + rest >= bound[a[live]])]
                if not len(live):
                    break
            scores[low + live] = exact_scores(anchors[a[live]], self.rows[b[live]])
            keep.append(low + live)
        keep = np.concatenate(keep)
        keep = keep[scores[keep] >= least[ai[keep]]]
        return ai[keep], self.place[bi[keep]], scores[keep]


def first_copies(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places, by id, without those that equal ``k`` rows of smaller ids in label and vector."""
    order = np.argsort(ids, kind="stable")
    codes = np.unique(labels[order], return_inverse=True)[1].astype(np.float64)
    whole = np.ascontiguousarray(np.concatenate([codes[:, None], rows[order] + 0.0], axis=1))
    _, group = np.unique(whole.view(np.dtype((np.void, whole.shape[1] * 8))).ravel(), return_inverse=True)
    by_group = np.argsort(group, kind="stable")
    sizes = np.bincount(group)
    rank = np.arange(len(group)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return order[np.sort(by_group[rank < k])]


def best(window: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first of each window: higher scores, then smaller ids."""
    order = np.lexsort((ids, -scores, window))
    w = window[order]
    starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.zeros(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(starts, np.diff(np.r_[starts, len(w)]))
    return order[rank < k]


@dataclass
class Anchors:
    """A block of anchors, one row per window: what labels it takes and between which scores."""

    window: np.ndarray  # name of the window
    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def find(self, space: Space, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the block, id, score) of the ``k`` first rows of each window."""
        keep = first_copies(ids, labels, rows, k + 1)
        ids, labels, rows = ids[keep], labels[keep], rows[keep][:, space.order]
        parts = []
        # Windows of one anchor are neighbours and are matched as one; anchors with like thresholds for their length are too.
        size = np.sqrt(np.einsum("ij,ij->i", self.rows, self.rows))
        own, member = np.unique(self.ids, return_inverse=True)
        least = np.full(len(own), np.inf)
        np.minimum.at(least, member, self.low / np.maximum(size, 1.0))
        by_label = (np.unique(self.labels, return_inverse=True)[1],) if same else ()
        want = np.lexsort((self.window, member, least[member], *by_label))
        for some in self._groups(want, same):
            here = np.flatnonzero(labels == self.labels[some[0]]) if same else np.arange(len(ids))
            for at in range(0, len(here), BLOCK_ROWS):
                block = here[at : at + BLOCK_ROWS]
                own, which = np.unique(self.ids[some], return_index=True)
                anchors = self.rows[some[which]][:, space.order]
                member = np.searchsorted(own, self.ids[some])
                least = np.full(len(own), np.inf)
                np.minimum.at(least, member, self.low[some])
                norms = suffix_norms(anchors)
                index = Index(rows[block], least, norms)
                ai, bi, scores = index.reaching(anchors, norms, least)
                bi = block[bi]
                ok = (ids[bi] != own[ai]) & ((labels[bi] == self.labels[some[which]][ai]) == same)
                ai, bi, scores = ai[ok], bi[ok], scores[ok]
                if not len(ai):
                    continue
                by_anchor = np.argsort(ai, kind="stable")
                ai, bi, scores = ai[by_anchor], bi[by_anchor], scores[by_anchor]
                start, end = np.searchsorted(ai, member, "left"), np.searchsorted(ai, member, "right")
                count = end - start
                w = np.repeat(np.arange(len(some)), count)
                pair = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(start, count)
                inside = (scores[pair] >= self.low[some[w]]) & (scores[pair] <= self.high[some[w]])
                w, pair = w[inside], pair[inside]
                top = best(w, ids[bi[pair]], scores[pair], k)
                parts.append((some[w[top]], ids[bi[pair[top]]], scores[pair[top]]))
        if not parts:
            return np.zeros(0, np.int64), np.zeros(0, ids.dtype), np.zeros(0, np.int64)
        w, found, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
        top = best(w, found, scores, k)
        return w[top], found[top], scores[top]

    def _groups(self, want: np.ndarray, same: bool) -> Iterator[np.ndarray]:
        at = 0
        while at < len(want):
            to = min(at + ANCHORS_AT_ONCE, len(want))
            if same:
                to = min(to, at + int(np.searchsorted(self.labels[want[at:to]], self.labels[want[at]], "right")))
            yield want[at:to]
            at = to


def learn_space(rows: DataFrame, scale: float) -> tuple[Space, int]:
    """The sample and the order of dimensions, and the greatest length of a vector."""
    width = rows.agg(F.max(F.size("vector"))).first()[0] or 0
    count = max(1, min(SAMPLE_ROWS, SAMPLE_BYTES // (8 * max(1, width))))
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(count).toArrow()
    sample = matrix(picked.column("vector"), width, scale) if picked.num_rows else np.zeros((0, width))
    order = np.argsort(-np.einsum("ij,ij->j", sample, sample), kind="stable")
    ids, labels = (picked.column(c).to_numpy() for c in ("vec_id", "label"))
    return Space(order, ids, labels, sample), width


def starting_levels(windows: DataFrame, space, width: int, scale: float, k: int, total: int, same: bool) -> DataFrame:
    """``windows`` with first and sure: scores of the sample at which about 2 k rows, and at least k rows, are expected.

    A window whose rows in the sample are too few has null.
    """
    schema = T.StructType([*windows.schema, T.StructField("first", T.LongType()), T.StructField("sure", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = space.value
        early = min(k, max(1, -(-2 * k * len(s.ids) // max(1, total))))
        for batch in batches:
            own, labels = batch.column("anchor_id").to_numpy(), batch.column("label").to_numpy()
            low, high = batch.column("floor").to_numpy(), batch.column("high").to_numpy()
            mine = matrix(batch.column("vector"), width, scale)
            levels: list[list[int | None]] = [[], []]
            for at in range(0, len(own), ANCHORS_AT_ONCE):
                cut = slice(at, at + ANCHORS_AT_ONCE)
                scores = mine[cut] @ s.rows.T  # rounded only beyond 2**53; a threshold need not be a score
                fits = ((s.labels[None, :] == labels[cut, None]) == same) & (s.ids[None, :] != own[cut, None])
                fits &= (scores >= low[cut, None]) & (scores <= high[cut, None])
                ranked = -np.sort(-np.where(fits, np.floor(scores * (1 - np.sign(scores) * 1e-12)), -np.inf), axis=1)
                for out, place in zip(levels, (early, k), strict=True):
                    nth = ranked[:, place - 1] if ranked.shape[1] >= place else np.full(len(ranked), -np.inf)
                    out += [None if x == -np.inf else max(int(x), least) for x, least in zip(nth.tolist(), low[cut].tolist(), strict=True)]
            extra = [pa.array(x, pa.int64()) for x in levels]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "first", "sure"])

    return windows.mapInArrow(work, schema)


def threshold_join(rows: DataFrame, windows: DataFrame, space, width: int, scale: float, k: int, same: bool, scratch: Scratch) -> DataFrame:
    """window_id, vec_id, score: the ``k`` first rows of each window, among those from its ``low`` up to its ``high``.

    ``windows`` has window_id, anchor_id, label, vector, low, high.
    """
    spark = rows.sparkSession
    size = windows.count() * (8 * max(1, width) + 64)
    blocks = max(1, -(-size // ANCHOR_BYTES))
    dealt = windows.withColumn("__block", F.pmod(F.xxhash64("anchor_id"), F.lit(blocks)))
    schema = "window_id long, vec_id " + rows.schema["vec_id"].dataType.simpleString() + ", score long"
    found = []
    for number in range(blocks):
        held = dealt.where(F.col("__block") == number).toArrow()
        if not held.num_rows:
            continue
        block = Anchors(
            *(held.column(c).to_numpy() for c in ("window_id", "anchor_id", "label")),
            matrix(held.column("vector"), width, scale),
            *(held.column(c).to_numpy().astype(np.float64) for c in ("low", "high")),
        )
        sent = spark.sparkContext.broadcast(block)

        def work(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            anchors, best_so_far, kind = sent.value, None, None

            def search(some: list[pa.RecordBatch]):
                table = pa.Table.from_batches(some)
                ids, labels = (table.column(c).to_numpy() for c in ("vec_id", "label"))
                w, names, scores = anchors.find(space.value, ids, labels, matrix(table.column("vector"), width, scale), k, same)
                if best_so_far is not None:
                    w, names, scores = (np.concatenate(x) for x in zip(best_so_far, (w, names, scores), strict=True))
                    top = best(w, names, scores, k)
                    w, names, scores = w[top], names[top], scores[top]
                return w, names, scores

            waiting, count = [], 0
            for batch in batches:
                kind = batch.schema.field("vec_id").type
                waiting.append(batch)
                count += batch.num_rows
                if count >= BLOCK_ROWS:
                    best_so_far, waiting, count = search(waiting), [], 0
            if waiting:
                best_so_far = search(waiting)
            if best_so_far is not None and len(best_so_far[0]):
                w, names, scores = best_so_far
                yield pa.RecordBatch.from_arrays([pa.array(anchors.window[w], pa.int64()), pa.array(names, kind), pa.array(scores, pa.int64())], ["window_id", "vec_id", "score"])

        near = rows.mapInArrow(work, schema)
        order = Window.partitionBy("window_id").orderBy(F.col("score").desc(), "vec_id")
        found.append(scratch.write(near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)))
        sent.destroy()
    if not found:
        return spark.createDataFrame([], schema + ", rank int")
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def fill_windows(rows: DataFrame, windows: DataFrame, space, width: int, scale: float, k: int, total: int, same: bool, scratch: Scratch) -> DataFrame:
    """window_id, vec_id, score, rank of the ``k`` first rows of each window of ``windows`` (window_id, anchor_id, label, vector,
    floor, high).

    Windows with fewer than ``k`` rows above their threshold are searched again with a lower one, at last their floor.
    """
    left = scratch.write(starting_levels(windows, space, width, scale, k, total, same))
    found = []
    for level in ("first", "sure", "floor"):
        low = F.coalesce(*[F.col(c) for c in ("first", "sure", "floor")[("first", "sure", "floor").index(level) :]])
        here = scratch.write(left.withColumn("low", low))
        if here.isEmpty():
            break
        near = threshold_join(rows, here, space, width, scale, k, same, scratch)
        filled = near.groupBy("window_id").count().where(F.col("count") >= k).select("window_id")
        again = scratch.write(here.where("low > floor").join(filled, "window_id", "left_anti").drop("low"))
        found.append(near.join(again.select("window_id"), "window_id", "left_anti"))
        left = again
    out = found[0] if found else rows.sparkSession.createDataFrame([], f"window_id long, vec_id {rows.schema['vec_id'].dataType.simpleString()}, score long, rank int")
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def mine(
    table: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: float = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors among ``table``.

    ``is_anchor`` and ``label`` (in place of the column) are conditions on vec_id and label. Each anchor has its first
    ``positives`` other rows of its label; each of them the first ``negatives`` rows of other labels with ``low`` to ``high`` percent of its
    score.
    """
    spark = table.sparkSession
    scratch = Scratch(spark)
    rows = vectors(table)
    if label is not None:
        rows = rows.withColumn("label", label)
    rows = rows.where("label is not null")
    found_space, width = learn_space(rows, scale)
    total = rows.count()
    space = spark.sparkContext.broadcast(found_space)
    anchors = scratch.write(rows.where(is_anchor).withColumn("window_id", F.monotonically_increasing_id()))
    own = anchors.select("window_id", F.col("vec_id").alias("anchor_id"), "label", "vector", F.lit(-_MOST).cast("long").alias("floor"), F.lit(_MOST).cast("long").alias("high"))
    near = fill_windows(rows, own, space, width, scale, positives, total, True, scratch)
    near = near.select("window_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.monotonically_increasing_id().alias("__w"))
    pairs = scratch.write(own.select("window_id", "anchor_id", "label", "vector").join(near, "window_id").drop("window_id").withColumnRenamed("__w", "window_id"))
    # low * positive <= 100 * score <= high * positive, in whole numbers
    share = lambda percent: F.col("positive_score").cast("decimal(20,0)") * F.lit(percent) / F.lit(100)
    windows = pairs.select("window_id", "anchor_id", "label", "vector", F.ceil(share(low)).cast("long").alias("floor"), F.floor(share(high)).cast("long").alias("high")).where("floor <= high")
    hard = fill_windows(rows, windows, space, width, scale, negatives, total, False, scratch)
    return hard.join(pairs.select("window_id", "anchor_id", "positive_id", "positive_score"), "window_id").select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def mine_sql(positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> str:
    """All scores of all anchors, ranked; for vectors of one length and ids that do not repeat."""
    first = "ORDER BY score DESC, vec_id"
    return f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS double))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS bigint) AS score
  FROM r a JOIN r b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (
  SELECT *, row_number() OVER (PARTITION BY anchor_id {first}) AS rn FROM s WHERE same) WHERE rn <= {positives}),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id {first}) AS int) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND {low} * positive_score <= 100 * score AND 100 * score <= {high} * positive_score)
SELECT * FROM n WHERE rank <= {negatives}"""
