"""Bounded samples of large tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Parts of a key that are ranked on their own first.
PARTS = 256


def first_per_key(rows: DataFrame, key: str, order: list[str], count: int) -> DataFrame:
    """The first ``count`` rows of each key in the given order.

    Parts of a key are cut to ``count`` rows before they meet, so that a key that holds most rows puts at most
    ``PARTS`` times ``count`` rows into one task.
    """
    part = F.pmod(F.xxhash64(*order), F.lit(PARTS))
    within = F.row_number().over(Window.partitionBy(key, "__part").orderBy(*order))
    few = rows.withColumn("__part", part).withColumn("__rank", within).where(F.col("__rank") <= count)
    overall = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return few.withColumn("__rank", overall).where(F.col("__rank") <= count).drop("__rank", "__part")
