"""What each of several filters does in every order in which they could be applied.

A document meets a set of filters it fails, so after one pass over the texts all that matters is how many
documents of a part fail exactly which set. The states of the lattice are the sets of filters applied so far; an
edge applies one more. What an edge removes follows from the counts alone: the documents that fail its filter and
none of the state's.

Orders are paths through the lattice. A forward pass counts the paths that reach each state, a backward pass those
that leave it for the full set; their product is the number of orders that use an edge, the weight of its removals
in the Shapley sums. The steps of a single order are read from the same edges.

Texts are read once and never shuffled: what leaves the scan is a row of id, part, failed filters and a digest of
the text (SHA-256) that tells equal texts.

Null texts are empty. A null part is the empty string. A null id is not smaller than any, nor any smaller than it,
so such rows are never later copies, and no label is theirs. Rows repeated with one id count each; labels repeated for one id count as one.
Other columns are not read, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lectern.scratch import Scratch

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_TEXT = "__text"
_WORDS = "__words"

NAMES = "ABCDE"


def text_filters() -> dict[str, Column | None]:
    """Failure conditions on ``__text``, never null, and ``__words``."""
    conditions = (
        F.size(_WORDS) < 200,
        100 * F.size(F.array_distinct(_WORDS)) < 50 * F.size(_WORDS),
        100 * (F.length(_TEXT) - F.length(F.translate(_TEXT, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 2 * F.length(_TEXT),
        F.col(_TEXT).rlike("[#$%&*|]"),
        None,  # the text of a smaller id, which takes all rows to tell
    )
    return dict(zip(NAMES, conditions, strict=True))


class Lattice:
    """Sets of ``names`` as bit masks, and how many orders pass through each edge from one to the next."""

    def __init__(self, names: Sequence[str]):
        self.names = tuple(names)
        n, full = len(self.names), (1 << len(self.names)) - 1
        self.reaching = [0] * (full + 1)
        self.leaving = [0] * (full + 1)
        self.reaching[0] = self.leaving[full] = 1
        steps = [(s, b) for s in range(full + 1) for b in range(n) if not s >> b & 1]
        for state, bit in steps:  # states in ascending order: every predecessor is done
            self.reaching[state | 1 << bit] += self.reaching[state]
        for state, bit in reversed(steps):
            self.leaving[state] += self.leaving[state | 1 << bit]
        self.edges = [(s, b, self.reaching[s] * self.leaving[s | 1 << b]) for s, b in steps]

    def orders(self) -> list[tuple[str, int, int, int]]:
        """(order, step, state, bit) for every step of every order."""
        out = []
        for order in permutations(range(len(self.names))):
            state, name = 0, "".join(self.names[b] for b in order)
            for step, bit in enumerate(order, 1):
                out.append((name, step, state, bit))
                state |= 1 << bit
        return out


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def failures(docs: DataFrame, part: str, filters: Mapping[str, Column | None]) -> DataFrame:
    """doc_id, part, mask, digest: which filters a row fails by itself. The bit of a copy filter is left open."""
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias(_TEXT))
    rows = rows.withColumn(_WORDS, words_of(F.col(_TEXT)))
    bits = [F.when(c, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(filters.values()) if c is not None]
    mask = sum(bits, F.lit(0)).alias("mask")
    return rows.select("doc_id", "part", mask, F.unhex(F.sha2(_TEXT, 256)).alias("digest"))


def counts_by_mask(rows: DataFrame, labels: DataFrame, copy_bit: int | None, scratch: Scratch) -> DataFrame:
    """part, mask, n, good, toxic from the rows of :func:`failures`.

    Rows alike in id and text are added up first. The first holder of each text is found by a rank limited on both
    sides of the shuffle, so a text that a third of all rows share sends one row per task.
    """
    alike = scratch.write(rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n")))
    if copy_bit is not None:
        copies = F.lit(1 << copy_bit)
        named = alike.where("doc_id is not null")
        first = named.withColumn("__rank", F.rank().over(Window.partitionBy("digest").orderBy("doc_id"))).where("__rank = 1")
        # Every row with an id counts as a later copy; first holders are then moved to where they belong.
        put, take = F.struct("mask", "n"), F.struct((F.col("mask") + copies).alias("mask"), (-F.col("n")).alias("n"))
        moved = first.select("doc_id", "part", F.explode(F.array(put, take)).alias("m")).select("doc_id", "part", "m.*")
        as_copy = F.when(F.col("doc_id").isNull(), F.col("mask")).otherwise(F.col("mask") + copies).alias("mask")
        alike = alike.select("doc_id", "part", as_copy, "n").unionByName(moved)
    flag = lambda name: F.coalesce(F.max((F.col(name) == 1).cast("long")), F.lit(0).cast("long"))
    wanted = labels.where("doc_id is not null and (quality = 1 or toxic = 1)")
    marks = wanted.groupBy("doc_id").agg(flag("quality").alias("good"), flag("toxic").alias("toxic"))
    none = F.lit(0).cast("long")
    lost = alike.join(marks, "doc_id").select("part", "mask", none.alias("n"), (F.col("n") * F.col("good")).alias("good"), (F.col("n") * F.col("toxic")).alias("toxic"))
    rows = alike.select("part", "mask", "n", none.alias("good"), none.alias("toxic")).unionByName(lost)
    return rows.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def edges(counts: DataFrame, lattice: Lattice) -> DataFrame:
    """part, state, bit, weight and ``COUNTS`` for every edge of the lattice and every part of ``counts``."""
    table = F.array(*[F.struct(F.lit(s).alias("state"), F.lit(b).alias("bit"), F.lit(1 << b).alias("own"), F.lit(w).cast("long").alias("weight")) for s, b, w in lattice.edges])
    on_edge = counts.withColumn("edge", F.explode(table)).select("part", "edge.*", "mask", "n", "good", "toxic")
    own = F.col("own")
    fails, earlier = F.col("mask").bitwiseAND(own) != 0, F.col("mask").bitwiseAND(F.col("state")) != 0
    amount = lambda what, when, name: F.sum(F.when(when, F.col(what)).otherwise(F.lit(0))).alias(name)
    return on_edge.groupBy("part", "state", "bit", "weight").agg(
        amount("n", ~fails & ~earlier, "kept"),
        amount("n", fails & ~earlier, "removed"),
        amount("n", fails & earlier, "redundant"),
        amount("n", F.col("mask") == own, "unique_fails"),
        amount("good", fails & ~earlier, "good_lost"),
        amount("toxic", fails & ~earlier, "toxic_lost"),
    )


def shapley(found: DataFrame) -> DataFrame:
    """part, bit, shapley: removals of a filter added up over all orders."""
    return found.groupBy("part", "bit").agg(F.sum(F.col("removed") * F.col("weight")).alias("shapley"))


def order_steps(found: DataFrame, lattice: Lattice) -> DataFrame:
    """part, filter_order, step, ``COUNTS`` and shapley: n! times n rows per part, n the number of filters."""
    schema = T.StructType([T.StructField("filter_order", T.StringType()), *[T.StructField(c, T.IntegerType()) for c in ("step", "state", "bit")]])
    steps = F.broadcast(found.sparkSession.createDataFrame(lattice.orders(), schema))  # fixed by the number of filters
    sums = found.withColumn("shapley", F.sum(F.col("removed") * F.col("weight")).over(Window.partitionBy("part", "bit")))
    return sums.join(steps, ["state", "bit"]).select("part", "filter_order", "step", *COUNTS, "shapley")


def audit(
    docs: DataFrame, labels: DataFrame, part: str = "source", filters: Mapping[str, Column | None] | None = None
) -> DataFrame:
    """The table of :func:`order_steps` for ``docs`` (doc_id, text and the part column) and ``labels`` (doc_id, quality, toxic).

    ``filters`` maps names of one letter to failure conditions on ``__text`` and ``__words``; at most one is None and
    stands for the text of a smaller id.
    """
    filters = text_filters() if filters is None else filters
    names = list(filters)
    open_bits = [i for i, n in enumerate(names) if filters[n] is None]
    if len(open_bits) > 1:
        raise ValueError("one copy filter at most")
    lattice = Lattice(names)
    counts = counts_by_mask(failures(docs, part, filters), labels, open_bits[0] if open_bits else None, Scratch(docs.sparkSession))
    return order_steps(edges(counts, lattice), lattice)


def audit_sql() -> str:
    """The same from the definition: every order walked on the counts of every set of failed filters."""
    orders = ", ".join(f"'{''.join(p)}'" for p in permutations(NAMES))
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS first_id FROM d),
f AS (SELECT doc_id, part, concat(
    CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END,
    CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END,
    CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 'C' ELSE '' END,
    CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
    CASE WHEN first_id < doc_id THEN 'E' ELSE '' END) AS fails FROM w),
l AS (SELECT doc_id, coalesce(max(CASE WHEN quality = 1 THEN 1 ELSE 0 END), 0) AS good, coalesce(max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
o AS (SELECT filter_order, step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS earlier
  FROM (SELECT unnest([{orders}]) AS filter_order), (SELECT unnest(range(1, {len(NAMES) + 1})) AS step)),
s AS (SELECT part, filter_order, CAST(step AS int) AS step, own,
    contains(fails, own) AS hit, earlier <> '' AND regexp_matches(fails, concat('[', earlier, '0]')) AS gone, fails, n, good, toxic FROM c, o),
r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END) AS removed, sum(CASE WHEN hit AND gone THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END) AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS bigint) AS kept, CAST(removed AS bigint) AS removed, CAST(redundant AS bigint) AS redundant,
  CAST(unique_fails AS bigint) AS unique_fails, CAST(good_lost AS bigint) AS good_lost, CAST(toxic_lost AS bigint) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, own) AS bigint) AS shapley FROM r"""
