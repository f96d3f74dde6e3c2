"""Importance resampling: documents drawn in proportion to how much likelier target text makes them than raw text.

Words and word pairs are hashed to ``BUCKETS`` buckets. The share of each bucket in target text and in all text are two
generative models; a document's log weight is its mean log ratio per n-gram, times ``GRAMS``, so that long
documents are no more extreme than short ones. Gumbel noise from a hash of doc_id is added and the documents with
the largest sums are selected: a draw without replacement in proportion to the weights.

Counts of raw text cover all documents. Target text is that of all trusted documents; their ids are
counted, and broadcast up to ``BROADCAST_IDS``. The rank of every document is exact: rows are range-partitioned by their sum and
numbered, and what precedes a partition is counted.

Null texts and texts without words have no log weight and come last. Equal rows differ in rank only. Without target text
all weights are equal; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lectern.llm.words import combine, hash_words, pieces, utf8
from lectern.scratch import Scratch

BUCKETS = 1 << 14
GRAMS = 64
BROADCAST_IDS = 1_000_000
SHARE = 0.5


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and word pair, and the row that it is in."""
    words, rows = hash_words(data, offsets)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(rows))
    pairs = combine(words, 2)
    inside = owner[1:] == owner[:-1] if len(owner) else np.zeros(0, bool)
    grams = np.concatenate([words, pairs[inside]])
    return (grams % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([owner, owner[1:][inside]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in pieces(batch, "text"):
            counts += np.bincount(features(*utf8(part.column("text")))[0], minlength=BUCKETS)
    used = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])


def counts_of(texts: DataFrame) -> np.ndarray:
    counted = texts.select("text").mapInArrow(_count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for r in counted.collect():  # at most BUCKETS rows
        out[r.bucket] = r.n
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    if not target.sum():
        return np.zeros(BUCKETS)
    return np.log((target + 1) / (target.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))


def _score(shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            for part in pieces(batch, "text"):
                bucket, owner = features(*utf8(part.column("text")))
                n = np.bincount(owner, minlength=part.num_rows)
                total = np.bincount(owner, weights=ratio[bucket], minlength=part.num_rows)
                weight = total / np.maximum(n, 1) * GRAMS
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(weight, pa.float64(), mask=n == 0)], ["doc_id", "log_weight"])

    return work


def gumbel(doc_id: Column) -> Column:
    """Noise of a document: a uniform number from 53 bits of a hash, made Gumbel."""
    uniform = (F.shiftrightunsigned(F.xxhash64(doc_id, F.lit("gumbel")), 11).cast("double") + 0.5) / float(1 << 53)
    return -F.log(-F.log(uniform))


def ranked(rows: DataFrame, order: list[Column], scratch: Scratch) -> DataFrame:
    """``rows`` with rank, from 1, in the given order; ``order`` should tell all rows apart."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()  # partition in the upper bits, row in the lower 33
    numbered = scratch.write(dealt.withColumn("__place", place))
    part = F.shiftright("__place", 33).alias("__part")
    sizes = numbered.groupBy(part).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))  # a row per partition
    joined = numbered.withColumn("__part", part).join(F.broadcast(starts), "__part")
    row = F.col("__place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.withColumn("rank", F.col("__before") + row + 1).drop("__part", "__place", "__before")


def resample(docs: DataFrame, trusted: DataFrame, share: float = SHARE, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """doc_id, log_weight, key (log weight plus noise), rank by key, and selected, for every document.

    ``trusted`` holds the doc_id of target documents; ``share`` of all documents are selected.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    chosen = trusted.select("doc_id").where("doc_id is not null").distinct()
    chosen = F.broadcast(chosen) if chosen.count() <= broadcast_ids else chosen.hint("merge")
    target = docs.select("doc_id", "text").join(chosen, "doc_id", "left_semi")
    shared = spark.sparkContext.broadcast(log_ratio(counts_of(target), counts_of(docs)))
    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", "text").mapInArrow(_score(shared), f"doc_id {kind}, log_weight double")
    key = F.coalesce(F.col("log_weight") + gumbel(F.col("doc_id")), F.lit(float("-inf")))
    staged = scratch.write(scored.withColumn("key", key).withColumn("__row", F.monotonically_increasing_id()))
    placed = ranked(staged, [F.col("key").desc(), F.col("doc_id").asc_nulls_last(), F.col("__row").asc()], scratch)
    count = int(np.ceil(share * staged.count()))
    return placed.select("doc_id", "log_weight", "key", "rank", (F.col("rank") <= count).alias("selected"))
