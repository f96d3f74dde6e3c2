"""Connected components of a large graph by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.scratch import Scratch


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root for every node of ``edges`` (a, b); nodes of one component share their root.

    Each round every node joins the neighbour whose hash is least, if it is less than its own; edges then run
    between what the nodes became. A round removes a constant share of the nodes, also on long chains, and a
    node with very many neighbours is only ever the target of a partial minimum.
    """
    edges = scratch.write(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    steps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(edges.select("b", "a"))
        least = both.groupBy("node").agg(F.min(F.struct(F.xxhash64("near").alias("hash"), "near")).alias("best"))
        own = F.struct(F.xxhash64("node").alias("hash"), F.col("node").alias("near"))
        step = scratch.write(least.select("node", F.least(own, F.col("best"))["near"].alias("root")))
        steps.append(step)
        left = step.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = step.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(left, "a").join(right, "b").where("ra <> rb")
        edges = scratch.write(moved.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct())
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = steps[0]
    for step in steps[1:]:
        later = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
        found = found.join(later, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
