"""Rows dealt to shards by a consistent-hash ring with virtual nodes and bounded loads.

The ring is cut into cells. A key's hash names its cell; the virtual nodes met clockwise from there
give the cell's order of shards. Keys arrive cell by cell, in an order that does not depend on the shards,
and each goes to the first shard of its order that is not full, so keys that overflow continue clockwise.
With ``slack`` 0 the loads are exact: no two shards differ by more than one row.

Only counts decide, so the driver sees one count per cell, a number fixed by ``CELLS``. The rows are numbered
in bounded stretches of a cell; a key that holds a third of all rows fills many stretches.

Null keys share one cell. Equal rows are different rows, with a slot each. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lectern.scratch import Scratch

CELLS = 1 << 14
VIRTUAL_NODES = 128
#: Rows numbered by one sort.
STRETCH_ROWS = 100_000

INTERVAL = T.StructType(
    [
        T.StructField("cell", T.IntegerType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("base", T.LongType()),
    ]
)


def cell_of(key: Column, cells: int = CELLS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(cells)).cast("int")


def ring(spark, shards: int, nodes: int = VIRTUAL_NODES, cells: int = CELLS) -> list[tuple[int, int]]:
    """(cell, shard) of every virtual node in clockwise order. A shard's nodes do not depend on the others."""
    rows = (
        spark.range(shards * nodes)
        .select((F.col("id") / nodes).cast("int").alias("shard"), (F.col("id") % nodes).alias("node"))
        .select(F.pmod(F.xxhash64(F.lit("node"), "shard", "node"), F.lit(cells)).cast("int").alias("cell"), "shard")
        .collect()
    )
    return sorted((r.cell, r.shard) for r in rows)


def clockwise(nodes: list[tuple[int, int]], cell: int) -> list[int]:
    """All shards in the order in which they are met from ``cell``."""
    at = bisect_left(nodes, (cell, -1))
    return list(dict.fromkeys(s for _, s in nodes[at:] + nodes[:at]))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    if not slack:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [-(-int(rows * (1 + slack) + 1) // shards)] * shards


def fill(counts: dict[int, int], nodes: list[tuple[int, int]], room: list[int], cells: int = CELLS) -> list[tuple[int, int, int, int, int]]:
    """(cell, low, high, shard, base): rows numbered low to high - 1 of a cell take slots from base of the shard."""
    used, out = [0] * len(room), []
    for turn in range(cells):
        cell = turn * 6364136223846793005 % cells  # every cell once; the factor is odd and cells a power of two
        low, left = 0, counts.get(cell, 0)
        if not left:
            continue
        for shard in clockwise(nodes, cell):
            n = min(left, room[shard] - used[shard])
            if n > 0:
                out.append((cell, low, low + n, shard, used[shard]))
                used[shard] += n
                low, left = low + n, left - n
            if not left:
                break
    return out


def assign(df: DataFrame, key: str, order: list[str], shards: int, slack: float = 0.0, nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``df`` with shard and slot (gapless from 0 in each shard), in place of columns so named.

    ``order`` are columns that order the rows of a cell; rows equal in them are told apart by their place in
    the input. ``df`` is read once and staged, so pass no wider rows than the result needs.
    """
    df = df.drop("shard", "slot")
    spark = df.sparkSession
    own = [f"__{n}" for n in ("row", "cell", "part", "rank", "before")]
    row, cell, part, rank, before = own
    staged = Scratch(spark).write(df.withColumn(row, F.monotonically_increasing_id()).withColumn(cell, cell_of(F.col(key))))
    counts = {r[0]: r[1] for r in staged.groupBy(cell).count().collect()}  # at most CELLS rows
    total = sum(counts.values())
    intervals = fill(counts, ring(spark, shards, nodes), capacities(total, shards, slack))
    plan = F.broadcast(spark.createDataFrame(intervals, INTERVAL))
    sizes = spark.createDataFrame([(c, -(-n // STRETCH_ROWS)) for c, n in counts.items()], "__c int, __parts long")
    parted = staged.join(F.broadcast(sizes), F.col(cell) == F.col("__c")).withColumn(part, F.pmod(F.xxhash64(row), F.col("__parts"))).drop("__c", "__parts")
    # Rows in the parts before, by counts: a cell has one part per stretch of rows.
    per_part = parted.groupBy(cell, part).agg(F.count("*").alias(rank))
    cumulative = Window.partitionBy(cell).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(F.col(cell).alias("__c"), F.col(part).alias("__p"), F.coalesce(F.sum(rank).over(cumulative), F.lit(0)).alias(before))
    within = Window.partitionBy(cell, part).orderBy(*order, row)
    numbered = parted.withColumn(rank, F.row_number().over(within) - 1)
    numbered = numbered.join(starts, (F.col(cell) == F.col("__c")) & (F.col(part) == F.col("__p"))).withColumn(rank, F.col(rank) + F.col(before)).drop("__c", "__p")
    inside = (numbered[cell] == plan["cell"]) & (numbered[rank] >= plan["low"]) & (numbered[rank] < plan["high"])
    placed = numbered.join(plan, inside)
    return placed.select(*[numbered[c] for c in df.columns], plan["shard"], (plan["base"] + numbered[rank] - plan["low"]).alias("slot"))


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document.

    The law is ``rows``: counts are at most one apart. A null text has size 1 and the checksum of no bytes.
    """
    bytes_ = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", (F.octet_length(bytes_) + 1).cast("long").alias("size"), F.crc32(bytes_).alias("text_crc32"))
    placed = assign(rows, "doc_id", ["doc_id", "size", "text_crc32"], shards)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
