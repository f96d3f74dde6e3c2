"""Command line: one subcommand per job, to be run with spark-submit.

    spark-submit -m lectern.jobs discover --feeds DIR --root DIR --date DAY
    spark-submit -m lectern.jobs land     --pages TABLE --root DIR --date DAY
    spark-submit -m lectern.jobs load     --root DIR --date DAY [--topic T] [--loader declared|inferred|files]
    spark-submit -m lectern.jobs index    --root DIR --date DAY [--embedder module:factory]
    spark-submit -m lectern.jobs export   --root DIR --date DAY --out DIR
    spark-submit -m lectern.jobs ask      --root DIR --questions TABLE --model module:factory --out DIR
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import json
from collections.abc import Callable, Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lectern.functions.embedding import Embedder, FunctionEmbedder, HashingEmbedder
from lectern.plans import pipeline, sinks
from lectern.schemas import MAX_BAD_RECORDS, TOP_K, UPDATE_ALL
from lectern.scratch import Scratch
from lectern.session import configure
from lectern.sources import feeds, layout
from lectern.sources.articles import read_silver


def _named(path: str) -> Callable:
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def _embedder(path: str | None) -> Embedder:
    return FunctionEmbedder(_named(path)) if path else HashingEmbedder()


def discover(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    """Feed files to URL lists and manifests; empty feeds and files outside the layout to error records.

    Feeds are parsed once. Links of a topic and day are ordered by feed file, then by their place in it.
    """
    with Scratch(spark) as scratch:
        found = feeds.read_feeds(spark, a.feeds).withColumn("run_date", F.coalesce("run_date", F.lit(a.date)))
        misplaced = found.where(F.col("topic").isNull()).select(F.lit(feeds.UNKNOWN_TOPIC).alias("topic"), "run_date", F.col("file").alias("url"), F.lit(feeds.MISPLACED).alias("error"))
        placed = feeds.number_files(found.where(F.col("topic").isNotNull()))
        items = scratch.write(feeds.keep_links(feeds.feed_items(placed)).select("topic", "run_date", "file", "pos", F.col("link").alias("url")))
        links = items.drop("file")
        if a.manual:
            manual = feeds.read_url_lists(spark, layout.manual_glob(a.root)).withColumn("run_date", F.lit(a.date))
            links = feeds.with_manual_fallback(links, feeds.number_rows(manual.select(*links.columns)))
        links = scratch.write(links)
        empty = placed.select("topic", "run_date", "file").join(items.select("topic", "run_date", "file").distinct(), ["topic", "run_date", "file"], "left_anti")
        errors = scratch.write(empty.select("topic", "run_date", F.col("file").alias("url"), F.lit(feeds.EMPTY_FEED).alias("error")).unionByName(misplaced))
        days = [r[0] for r in links.select("run_date").union(errors.select("run_date")).distinct().collect()]  # a row per day
        for day in days:
            on_day = links.where(F.col("run_date") == day)
            sinks.write_url_lists(on_day, f"{a.root}/{layout.TOPIC_URLS}", day, F.current_timestamp())
            sinks.write_manifests(on_day, f"{a.root}/{layout.MANIFESTS}", size=a.block)
        for day in days:
            sinks.write_feed_errors(errors.where(F.col("run_date") == day).drop("run_date"), f"{a.root}/{layout.ERRORS}", day, True)
        if not a.allow_empty and not errors.isEmpty():
            raise sinks.EmptyFeedError("a feed gave no links")
        return {"urls": links.count()}


def land(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    pages = spark.read.parquet(a.pages)
    return pipeline.land_pages(spark, pages, a.root, a.date, a.stamp, a.rules)


def _collector(spark: SparkSession, a: argparse.Namespace) -> pipeline.ArticleCollector:
    return pipeline.ArticleCollector(
        spark,
        a.root,
        _embedder(getattr(a, "embedder", None)),
        topic=a.topic,
        stamp=a.stamp,
        max_bad=getattr(a, "max_bad", MAX_BAD_RECORDS),
        chunker=getattr(a, "chunker", "whitespace"),
        index_by=getattr(a, "index_by", "published"),
        exclude_gated=not getattr(a, "include_gated", False),
    )


def load(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    collector = _collector(spark, a)
    if a.loader == "files":
        merged = pipeline.load_files(spark, collector.extract(a.date), collector.silver, UPDATE_ALL, collector.rejects, a.date)
        return {"rows_merged": merged}
    if a.loader == "inferred":
        return {"rows_merged": pipeline.load_inferred(spark, collector.extract(a.date), collector.silver, collector.rejects, a.date)}
    return collector.load(a.date)


def index(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    collector = _collector(spark, a)
    return {**collector.index(a.date), "undated": pipeline.skipped_by_index(spark, collector.silver)}


def export(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    sinks.export_documents(read_silver(spark, f"{a.root}/silver"), a.out, a.date)
    return {"documents": spark.read.schema("text_content string").json(a.out).count()}


def ask(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    questions = spark.read.parquet(a.questions)
    answers = pipeline.ask(spark, questions, a.root, _embedder(a.embedder), _named(a.model), a.k)
    answers.write.mode("overwrite").parquet(a.out)
    return {"answers": spark.read.parquet(a.out).count()}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lectern", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)
    today = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)

    def command(job: Callable, *required: str) -> argparse.ArgumentParser:
        p = commands.add_parser(job.__name__)
        p.set_defaults(job=job)
        for name in ("root", *required):
            p.add_argument(f"--{name}", required=True)
        p.add_argument("--date", default=today.date().isoformat())
        p.add_argument("--stamp", type=dt.datetime.fromisoformat, default=today)
        p.add_argument("--topic", default="*")
        return p

    p = command(discover, "feeds")
    p.add_argument("--allow-empty", action="store_true")
    p.add_argument("--manual", action="store_true", help="use the manual URL lists for topics without a feed")
    p.add_argument("--block", type=int, default=2500)
    p = command(land, "pages")
    p.add_argument("--rules", choices=("canonical", "legacy"), default="canonical")
    p = command(load)
    p.add_argument("--loader", choices=("declared", "inferred", "files"), default="declared")
    p.add_argument("--max-bad", type=int, default=MAX_BAD_RECORDS)
    p = command(index)
    p.add_argument("--embedder")
    p.add_argument("--chunker", choices=("whitespace", "fixed", "tokens"), default="whitespace")
    p.add_argument("--index-by", choices=("published", "ingested"), default="published")
    p.add_argument("--include-gated", action="store_true")
    command(export, "out")
    p = command(ask, "questions", "model", "out")
    p.add_argument("--embedder")
    p.add_argument("--k", type=int, default=TOP_K)
    return top


def main(arguments: Sequence[str] | None = None) -> dict[str, int]:
    a = parser().parse_args(arguments)
    spark = configure(SparkSession.builder.appName(f"lectern-{a.command}")).getOrCreate()
    done = a.job(spark, a)
    print(json.dumps({"job": a.command, **done}))
    return done


if __name__ == "__main__":
    main()
