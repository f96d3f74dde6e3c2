"""JSON outputs of the landing area."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions import derive
from lectern.operators.blocks import list_documents, with_blocks
from lectern.operators.chunking import open_articles
from lectern.schemas import ARTICLE_COLUMNS, MANIFEST_URLS
from lectern.scratch import Scratch, exists, remove
from lectern.sources.articles import published_on


class EmptyFeedError(RuntimeError):
    """A feed that was asked for gave no link; its error record has been written."""


def write_json(df: DataFrame, path: str, partitions: Sequence[str] = (), mode: str = "overwrite") -> None:
    """JSON lines under ``path``; a partition value with too many rows for one task is split.

    Overwriting replaces only the partitions written.
    """
    if partitions:
        df = df.hint("rebalance", *partitions)
    writer = df.write.mode(mode).option("ignoreNullFields", False)
    if partitions:
        writer = writer.partitionBy(*partitions).option("partitionOverwriteMode", "dynamic")
    writer.json(path)


def bronze_rows(articles: DataFrame, run_date: str) -> DataFrame:
    """Article rows with the columns their path is made of."""
    return articles.select(
        *ARTICLE_COLUMNS, F.lit(run_date).alias("run_date"), derive.url_slug("article_url").alias("slug")
    )


def write_bronze(articles: DataFrame, path: str, run_date: str) -> None:
    """Land articles under ``topic=…/run_date=…``, many rows to a file, the slug kept as a column.

    Appends: rows landed earlier the same day stay, and the caller leaves out the slugs that exist.
    """
    rows = bronze_rows(articles, run_date)
    # The folder takes the topic out of the rows, so the record keeps a copy for its reader.
    write_json(rows.withColumn("folder", F.col("topic")), path, ("folder", "run_date"), mode="append")


def _folder_name(value: str | None) -> str:
    """How Spark writes a partition value in a path."""
    if not value:
        return "__HIVE_DEFAULT_PARTITION__"
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or c in "\"#%'*/:=?\\\x7f{[]^" else c for c in value)


def write_errors(errors: DataFrame, path: str, run_date: str, retried: DataFrame | None = None) -> None:
    """Dead letters of a day; the batch goes on.

    ``retried`` names, by ``topic, url``, what this run has tried: earlier records of it are replaced, or vanish
    when it succeeded, and those of other pages stay. Without it the day's records are all replaced.
    """
    spark = errors.sparkSession
    rows = errors.withColumn("run_date", F.lit(run_date)).withColumn("folder", F.col("topic"))
    if not exists(spark, path):
        write_json(rows, path, ("folder", "run_date"))
        return
    with Scratch(spark) as scratch:
        held = spark.read.schema(T.StructType(rows.schema.fields)).json(path).where(F.col("run_date") == run_date)
        old = scratch.write(held.select(*[F.col(c).cast(rows.schema[c].dataType) for c in rows.columns]))
        left = old.where(F.lit(False)) if retried is None else old.join(retried.select("topic", "url").distinct(), ["topic", "url"], "left_anti")
        staged = scratch.write(rows.unionByName(left))
        kept = {r[0] for r in staged.select("folder").distinct().collect()}  # topics of one day
        for gone in {r[0] for r in old.select("folder").distinct().collect()} - kept:
            remove(spark, f"{path}/folder={_folder_name(gone)}/run_date={run_date}")
        write_json(staged, path, ("folder", "run_date"))


def write_feed_errors(errors: DataFrame, path: str, run_date: str, allow_empty: bool = False) -> None:
    """Error rows of empty or broken feeds; then stop, unless ``allow_empty``."""
    if errors.isEmpty():
        return
    write_errors(errors, path, run_date)
    if not allow_empty:
        raise EmptyFeedError("a feed gave no links")


def url_lists(links: DataFrame, group: Sequence[str], order: str = "pos", size: int = MANIFEST_URLS) -> DataFrame:
    """URL-list documents ``topic, timestamp?, urls``: one per topic up to ``size`` URLs, then more."""
    return list_documents(with_blocks(links, group, order, size), group, "url", size)


def write_url_lists(
    links: DataFrame, path: str, run_date: str, stamp: Column, order: str = "pos", size: int = MANIFEST_URLS
) -> None:
    """URL-list documents as JSON lines, the blocks of a topic in one folder."""
    documents = url_lists(links, ["topic"], order, size).select(
        "topic", stamp.cast("string").alias("timestamp"), "urls", F.lit(run_date).alias("run_date"),
        F.col("topic").alias("folder"),
    )
    write_json(documents, path, ("folder", "run_date"))


def write_manifests(links: DataFrame, path: str, order: str = "pos", size: int = MANIFEST_URLS) -> None:
    """Ordered URL blocks, one JSON array per line, under ``topic=…/run_date=…/block_id=…``.

    ``links`` has ``topic, run_date, url`` and an integer order column.
    """
    documents = url_lists(links, ["topic", "run_date"], order, size)
    texts = documents.select("topic", "run_date", "block_id", F.to_json("urls").alias("value"))
    (
        texts.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", "run_date", "block_id")
        .text(path)
    )


def prepared_documents(articles: DataFrame, day: str) -> DataFrame:
    """``text_content`` of the open articles published on ``day``."""
    return published_on(articles, day).where(open_articles()).select(
        derive.prepared_document(day).alias("text_content")
    )


def export_documents(articles: DataFrame, path: str, day: str) -> None:
    prepared_documents(articles, day).write.mode("overwrite").json(path)
