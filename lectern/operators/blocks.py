"""Numbering an ordered list in blocks of fixed size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.schemas import MANIFEST_URLS
from lectern.scratch import Scratch

def with_blocks(
    df: DataFrame, group: Sequence[str], order: str, size: int = MANIFEST_URLS, parts: int | None = None
) -> DataFrame:
    """Add ``position`` (from 0, by ``order`` inside ``group``) and ``block_id = position // size``.

    ``order`` may be dense, sparse or repeat; rows alike in it are put in order by a hash of the whole row. A group may hold
    most of the rows, so nothing spans one: the rows move once, into ranges of group, order and hash, as many as the session
    has shuffle partitions (or ``parts``), and are staged with their place in their range. What is summed up to number them is one row
    for each group in each range.
    """
    spark = df.sparkSession
    # One struct as the key: it is never null, also where a group column is, and the sums and the join then agree on it.
    key, by = F.struct(*group), ("__key", order, "__tie")
    keyed = df.withColumns({"__key": key, "__tie": F.xxhash64(*df.columns)})
    ranges = keyed.repartitionByRange(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by)
    # The number of the range in the upper bits, the row's place in it in the lower 33.
    placed = Scratch(spark).write(ranges.withColumn("__place", F.monotonically_increasing_id()).drop("__tie"))
    placed = placed.withColumn("__range", F.shiftright("__place", 33))
    runs = placed.groupBy("__key", "__range").agg(F.min("__place").alias("__first"), F.count("*").alias("__n"))
    before = Window.partitionBy("__key").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("__key", "__range", (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"))
    position = F.col("__place") + F.col("__shift")
    return placed.join(starts, ["__key", "__range"]).select(
        *df.columns, position.alias("position"), F.floor(position / F.lit(size)).alias("block_id")
    )


def list_documents(df: DataFrame, group: Sequence[str], value: str = "url", size: int = MANIFEST_URLS) -> DataFrame:
    """Blocks as rows with an ordered ``urls`` array of at most ``size`` elements."""
    items = F.array_sort(F.collect_list(F.struct("position", value)))
    return (
        df.groupBy(*group, "block_id")
        .agg(items.alias("__items"))
        .select(*group, "block_id", F.transform("__items", lambda x: x[value]).alias("urls"))
    )
