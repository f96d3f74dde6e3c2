"""Copies of documents so that every source gets its share of the mix.

A source's target is its share by weight of all words, at most ``MOST`` times its own; what is over is shared out again
by weight. Each document of a source is then to be taken target / size times, a whole number of copies and
a fraction. The fractions are rounded together by the pivotal method: two documents with a fraction are paired and
words at stake move from one to the other, up or down at random so that every expectation is kept, until one of them
has a whole number. The other goes on to the next pair. The words a source takes never change on the way.

Pairs meet in a tree. Leaves of about ``LEAF`` documents are dealt by a hash, each leaves at most one document
undecided, and those meet again ``LEAF`` at a time up to the root. About ``ROOT`` documents of a source, chosen by a hash,
wait for the root, where larger ones are paired first: so many small ones are left to take up what the long ones
leave over that the last, which is drawn by its fraction, is small. What a source takes differs from its target
by less than that one. Every random number is a hash of the document, so runs agree however the rows are dealt.

Rows alike in source, id and size are one item with a count; of their copies only the sum's fraction is at stake.
A null text has no words, a null source is a source of its own, the last. A document of no words is taken as no
words. Columns other than doc_id, source and text are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.audit import words_of
from lectern.llm.importance import ranked
from lectern.scratch import Scratch

WEIGHTS = (1, 2, 3)
#: No source and no document is taken more often than this.
MOST = 3
#: Documents that one task pairs at a time, on average.
LEAF = 256
#: Documents of a source, about, that are paired last.
ROOT = 1024
SOURCE_BYTES = 32 * 1024 * 1024
SALTS = 64
#: Equal rows written out by one step of a generator.
STRETCH = 65_536

_EXACT = "decimal(38,0)"


def document_sizes(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.size(words_of(F.coalesce("text", F.lit("")))).cast("long").alias("size"))


def water_level(sources: DataFrame, most: int = MOST) -> Fraction:
    """Words per unit of weight at which the targets add up to all words.

    ``sources`` has source_size and weight. A pass adds up the sources that are full at the level so far; the level rises until no
    more are. Only sums come to the driver.
    """
    cap, weight = (F.col("source_size") * most).cast(_EXACT), F.col("weight").cast(_EXACT)
    total = sources.agg(F.sum(F.col("source_size").cast(_EXACT)).alias("words"), F.sum(weight).alias("weight")).first()
    words, level, full = int(total["words"] or 0), Fraction(0), -1
    if words:
        level = Fraction(words, int(total["weight"]))
    while words:
        is_full = cap * F.lit(level.denominator).cast(_EXACT) <= weight * F.lit(level.numerator).cast(_EXACT)
        found = sources.agg(
            F.count(F.when(is_full, 1)).alias("n"), F.sum(F.when(is_full, cap)).alias("words"), F.sum(F.when(~is_full, weight)).alias("weight")
        ).first()
        if found["n"] == full or not found["weight"]:
            break
        full, level = found["n"], Fraction(words - int(found["words"] or 0), int(found["weight"]))
    return level


def source_targets(items: DataFrame, scratch: Scratch, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, items, weight, target, base and share (copies of each document: whole ones and a fraction)."""
    totals = items.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count("*").alias("items"))
    numbered = ranked(totals, [F.col("source").asc_nulls_last()], scratch)
    cycle = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int") + 1)
    sources = scratch.write(numbered.withColumn("weight", cycle).drop("rank"))
    level = water_level(sources, most)
    up, down = F.lit(level.numerator).cast(_EXACT), F.lit(level.denominator).cast(_EXACT)
    cap = F.col("source_size") * most
    full = cap.cast(_EXACT) * down <= F.col("weight").cast(_EXACT) * up
    target = F.when(full, cap.cast("double")).otherwise(F.col("weight") * F.lit(level.numerator / level.denominator))
    # weight * level / source_size as a whole number and a rest, exactly.
    unit = F.greatest(F.col("source_size"), F.lit(1)).cast(_EXACT) * down
    ratio = sources.select("*", target.alias("target"), full.alias("__full"), (F.col("weight").cast(_EXACT) * up).alias("__wanted"), unit.alias("__unit"))
    whole, rest = F.expr("__wanted div __unit").cast("int"), F.expr("__wanted % __unit").cast("double") / F.col("__unit").cast("double")
    copies = ratio.withColumn("base", F.when(F.col("__full"), F.lit(most)).otherwise(whole))
    return copies.withColumn("share", F.when(F.col("__full"), F.lit(0.0)).otherwise(rest)).drop("__full", "__wanted", "__unit")


def _with_source(items: DataFrame, sources: DataFrame) -> DataFrame:
    """``items`` with the columns of their source. Many sources are joined with the rows of each dealt to ``SALTS`` tasks."""
    right = sources.withColumnRenamed("source", "__source")
    weight = sources.agg(F.coalesce(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64), F.lit(0))).first()[0]
    same = items["source"].eqNullSafe(right["__source"])
    if weight <= SOURCE_BYTES:
        return items.join(F.broadcast(right), same).drop("__source")
    left = items.withColumn("__salt", F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int"))
    right = right.withColumn("__salt2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, left["source"].eqNullSafe(right["__source"]) & (left["__salt"] == right["__salt2"])).drop("__source", "__salt", "__salt2")


def _uniform(seed: int, level: int) -> Column:
    bits = F.xxhash64(F.lit(seed), F.lit(level), "source", "doc_id", "size")
    return (F.shiftrightunsigned(bits, 11).cast("double") + 0.5) / float(1 << 53)


def pivot(sizes: Sequence[float], shares: Sequence[float], draws: Sequence[float]) -> tuple[list[int], int, float]:
    """Round ``shares`` to 0 or 1 with the sum of size times share kept.

    Returns the rounded shares, the place of the one left undecided (-1: none) and what its share is by now.
    """
    out, held, part = [0] * len(sizes), -1, 0.0
    for j, (size, share, draw) in enumerate(zip(sizes, shares, draws, strict=True)):
        if held < 0:
            held, part = j, share
            continue
        room, stake = (1.0 - part) * sizes[held], part * sizes[held]
        other_room, other_stake = (1.0 - share) * size, share * size
        gain, loss = min(room, other_stake), min(stake, other_room)
        if draw * (gain + loss) < loss:  # the held one gains, with the chance that keeps its expectation
            if other_stake <= room:
                part += other_stake / sizes[held]
            else:
                out[held], held, part = 1, j, share - room / size
        elif stake <= other_room:
            held, part = j, share + stake / size
        else:
            out[j], part = 1, part - other_room / sizes[held]
        if part <= 0.0 or part >= 1.0:
            out[held], held = int(part >= 1.0), -1
    return out, held, part


def _pair(rows: pa.Table) -> pa.Table:
    """One group: larger documents first, ``bump`` for the decided ones and a new ``part`` for the one that is not."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=[("size", "descending"), ("doc_id", "ascending")]))
    sizes, parts, draws = (rows.column(c).to_pylist() for c in ("size", "part", "draw"))
    bump, left, part = pivot(sizes, parts, draws)
    if left >= 0 and rows.column("last")[0].as_py():
        bump[left], left = int(draws[left] < part), -1
    share = np.zeros(len(bump))
    if left >= 0:
        share[left] = part
    out = rows.set_column(rows.schema.get_field_index("bump"), "bump", pa.array(bump, pa.int32()))
    return out.set_column(out.schema.get_field_index("part"), "part", pa.array(share, pa.float64())).drop_columns(["draw", "last"])


def round_copies(items: DataFrame, scratch: Scratch, leaf: int = LEAF, root: int = ROOT, seed: int = 0) -> DataFrame:
    """``items`` (source, doc_id, size, n, items, part and others) with ``bump``: 0 or 1, in expectation ``part``.

    ``items`` is the number of rows of the source. It is read several times, so it should be staged.
    """
    open_ = F.col("part") > 0
    items = items.withColumn("bump", F.lit(0))
    leaves = F.greatest(F.ceil(F.col("items") / leaf), F.lit(1))
    waits = F.pmod(F.xxhash64(F.lit("root"), "doc_id", "size"), F.col("items")) < root
    left = items.where(open_ & ~waits).withColumn("node", F.pmod(F.xxhash64("doc_id", "size"), leaves))
    nodes = items.agg(F.max(F.when(F.col("items") > root, leaves).otherwise(F.lit(0)))).first()[0] or 0
    done, level = [items.where(~open_)], 0
    while True:
        last = nodes <= 1
        if last:
            left = left.unionByName(items.where(open_ & waits).withColumn("node", F.lit(0).cast("long")))
        rows = left.withColumn("draw", _uniform(seed, level)).withColumn("last", F.lit(last))
        schema = T.StructType([f for f in rows.schema if f.name not in ("draw", "last")])
        paired = scratch.write(rows.groupBy("source", "node").applyInArrow(_pair, schema))
        done.append(paired.where(~open_).drop("node"))
        if last:
            break
        left = paired.where(open_).withColumn("node", F.floor(F.col("node") / leaf))
        nodes, level = -(-nodes // leaf), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, leaf: int = LEAF, root: int = ROOT, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken, source for every document: ``taken`` words, whole copies added up."""
    scratch = Scratch(docs.sparkSession)
    items = scratch.write(document_sizes(docs).groupBy("source", "doc_id", "size").agg(F.count("*").alias("n")))
    found = _with_source(items, source_targets(items, scratch, weights, most))
    at_stake = F.when(F.col("size") > 0, F.col("share") * F.col("n")).otherwise(F.lit(0.0))
    wanted = found.withColumn("extra", F.floor(at_stake)).withColumn("part", at_stake - F.floor(at_stake)).drop("share", "weight")
    copies = round_copies(scratch.write(wanted), scratch, leaf, root, seed)
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / STRETCH)))
    first = F.col("__block") * STRETCH
    place = F.explode(F.sequence(first, F.least(F.col("n") - 1, first + STRETCH - 1)))
    each = copies.withColumn("__block", block).withColumn("__place", place)
    taken = F.col("size") * (F.col("base") + (F.col("__place") < F.col("extra") + F.col("bump")).cast("int"))
    return each.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"), "source")
