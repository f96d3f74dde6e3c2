"""Keyed upserts, deletes by key and the anti joins around them.

Parquet has no row-level MERGE, so the new content of a table is computed as a join. The joins here
take plain DataFrames; ``lectern.plans.tables`` decides which partitions they have to read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from lectern.operators.places import FILE, INDEX, placed, without
from lectern.schemas import ARTICLE_COLUMNS, UPDATE_PARTIAL
from lectern.scratch import Scratch


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = ("article_url",), order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the last ingested, ties by content hash, then by the whole row.

    ``row_number() = 1`` plans as a group limit on both sides of the shuffle, so each map task sends
    one row per key however often the key repeats.
    """
    ranked = list(order) if order else [F.col("ingested_at").desc_nulls_last(), F.col("content_hash")]
    ranked.append(F.xxhash64(*df.columns))
    spot = "__rank"
    window = Window.partitionBy(*keys).orderBy(*ranked)
    return df.withColumn(spot, F.row_number().over(window)).where(F.col(spot) == 1).drop(spot)


#: Address of a row within one stage, and a hash of the whole row that orders rows alike in time and content.
ROW, TIE = "__row", "__tie"


def addressed(df: DataFrame) -> DataFrame:
    """``df`` with the columns that :func:`superseded` needs. Write it before use: addresses hold only for stored rows."""
    return df.withColumns({TIE: F.xxhash64(*df.columns), ROW: F.monotonically_increasing_id()})


def superseded(stored: DataFrame, key: str = "article_url") -> DataFrame:
    """Addresses of the rows that :func:`latest_per_key` would leave out, and places if there are; only key, time, hashes and these are read and moved."""
    places = [c for c in (FILE, INDEX) if c in stored.columns]
    narrow = stored.select(key, "ingested_at", "content_hash", TIE, ROW, *places)
    later = Window.partitionBy(key).orderBy(F.col("ingested_at").desc_nulls_last(), "content_hash", TIE, ROW, *places)
    return narrow.withColumn("__rank", F.row_number().over(later)).where("__rank > 1").select(ROW, *places)


def settled(stored: DataFrame, key: str, order: Sequence[Column], scratch: Scratch, broadcast_bytes: int) -> DataFrame:
    """:func:`latest_per_key` of stored rows, in place: of keys that do not repeat only the keys move.

    Of those that repeat the columns of ``order``, a hash and the place of each row move, and the rows to leave out are told by their
    places, so whole rows stay where they are however many keys repeat.
    """
    size = Observation()
    many = stored.groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1").select(key)
    repeated = scratch.write(many.observe(size, F.count("*").alias("rows"), F.coalesce(F.sum(F.octet_length(key) + 64), F.lit(0)).alias("bytes")))
    if not size.get["rows"]:
        return stored
    rows = placed(stored.withColumn(TIE, F.xxhash64(*stored.columns)))
    some = rows.join(F.broadcast(repeated) if size.get["bytes"] <= broadcast_bytes else repeated, key, "left_semi")
    # First ranks alone are limited in each task before they move, so a key that repeats often costs no task more than others.
    first = some.withColumn("__rank", F.row_number().over(Window.partitionBy(key).orderBy(*order, TIE, FILE, INDEX))).where("__rank = 1")
    out = some.select(FILE, INDEX).join(first.select(FILE, INDEX), [FILE, INDEX], "left_anti")
    return without(placed(stored), scratch.write(out), scratch, broadcast_bytes).select(*stored.columns)


def require_key(df: DataFrame, key: str = "article_url") -> DataFrame:
    """The job fails if a row has no key."""
    return df.withColumn(key, F.coalesce(F.col(key), F.raise_error(F.lit(f"{key} is required"))))


def _merged(columns: Sequence[str], key: str, update: set[str]) -> list[Column]:
    has_source, has_target = F.col(f"s.{key}").isNotNull(), F.col(f"t.{key}").isNotNull()
    out = []
    for c in columns:
        source, target = F.col(f"s.{c}"), F.col(f"t.{c}")
        if c == key:
            out.append(F.coalesce(source, target).alias(c))
        elif c in update:
            out.append(F.when(has_source, source).otherwise(target).alias(c))
        else:
            out.append(F.when(has_target, target).otherwise(source).alias(c))
    return out


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: str = "article_url",
    update_cols: Sequence[str] = UPDATE_PARTIAL,
    columns: Sequence[str] = ARTICLE_COLUMNS,
) -> DataFrame:
    """New content of ``target``: matched rows take ``update_cols``, other source rows are added.

    ``key`` must be unique in each input (see :func:`latest_per_key`). Both sides shuffle once on
    the key.
    """
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full_outer")
    return joined.select(*_merged(columns, key, set(update_cols)))


def kept_columns(update_cols: Sequence[str], key: str = "article_url", columns: Sequence[str] = ARTICLE_COLUMNS) -> list[str]:
    """What a matched row of the target keeps."""
    return [c for c in columns if c != key and c not in set(update_cols)]


def kept_apart(matched: DataFrame, source: DataFrame, key: str, kept: Sequence[str], carried: Sequence[str] = ()) -> DataFrame:
    """``key`` and ``kept`` of the matched rows that keep another value than the source has, and what of it is ``carried``; no other column is read or moved."""
    same = F.lit(True)
    for c in kept:
        same &= F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}"))
    both = matched.select(key, *kept).alias("t").join(source.select(key, *kept, *carried).alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"))
    return both.where(~same).select("t.*", *[f"s.{c}" for c in carried])


def upsert_kept(source: DataFrame, held: DataFrame, key: str, kept: Sequence[str]) -> DataFrame:
    """``source`` with the ``kept`` columns of ``held`` where it has the key: :func:`upsert` when every key of the target is in ``source``."""
    joined = source.alias("s").join(held.alias("t"), F.col(f"t.{key}") == F.col(f"s.{key}"), "left_outer")
    ours = F.col(f"t.{key}").isNotNull()
    return joined.select(*[F.when(ours, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}")).alias(c) if c in kept else F.col(f"s.{c}") for c in source.columns])


def split_by_keys(rows: DataFrame, keys: DataFrame, key: str = "article_url") -> tuple[DataFrame, DataFrame]:
    """(rows whose key is in ``keys``, all other rows), for keys the caller has measured and found small.

    Both parts leave the rows where they are.
    """
    small = F.broadcast(keys.select(key))
    return rows.join(small, key, "left_semi"), rows.join(small, key, "left_anti")


def upsert_in_place(
    target: DataFrame,
    source: DataFrame,
    key: str = "article_url",
    update_cols: Sequence[str] = UPDATE_PARTIAL,
    columns: Sequence[str] = ARTICLE_COLUMNS,
) -> DataFrame:
    """:func:`upsert` for a source with few keys: only matched target rows move, the others stay.

    A full outer join cannot broadcast, so the target is split first by the source's keys.
    """
    matched, others = split_by_keys(target, source, key)
    return others.select(*columns).unionByName(upsert(matched, source, key, update_cols, columns))


def upsert_chunks(target: DataFrame, source: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Replace by chunk id or insert. Ids that the source no longer produces stay."""
    others = [c for c in target.columns if c != key]
    return upsert(target, source, key, others, target.columns)


def delete_by_key(rows: DataFrame, keys: DataFrame, key: str = "article_url") -> DataFrame:
    """Rows whose key is not in ``keys``. An anti join: a null key deletes nothing."""
    return rows.join(keys.select(key), key, "left_anti")


def first_landing(candidates: DataFrame, order: str, keys: Sequence[str] = ("topic", "run_date", "slug")) -> DataFrame:
    """Of candidates that would land on the same path, the first."""
    return latest_per_key(candidates, keys, [F.col(order)])


def skip_landed(
    candidates: DataFrame, landed: DataFrame, keys: Sequence[str] = ("topic", "run_date", "slug")
) -> DataFrame:
    """Candidates whose path does not exist yet."""
    return candidates.join(landed.select(*keys), list(keys), "left_anti")


def changed_records(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows that are new or whose content hash differs. Null hashes compare as equal."""
    known = existing.select("article_url", "content_hash").alias("k")
    rows = incoming.alias("i")
    same = F.col("i.article_url").eqNullSafe(F.col("k.article_url")) & F.col("i.content_hash").eqNullSafe(
        F.col("k.content_hash")
    )
    return rows.join(known, same, "left_anti")
