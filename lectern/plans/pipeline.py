"""The daily job and the question job, put together from the operators."""

from __future__ import annotations

import datetime as dt
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from py4j.protocol import Py4JError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.functions import derive
from lectern.functions.embedding import Embedder
from lectern.operators import contract
from lectern.operators.answer import answer_questions
from lectern.operators.bloom import in_filter
from lectern.operators.extract import extract_articles, split_errors
from lectern.operators.upsert import ROW, TIE, first_landing, skip_landed
from lectern.plans import sinks
from lectern.plans.journal import Journal
from lectern.plans.keyed import ConflictError
from lectern.plans.tables import index_day, merge_silver
from lectern.schemas import ARTICLE_COLUMNS, MAX_BAD_RECORDS, UPDATE_PARTIAL
from lectern.scratch import Scratch, exists
from lectern.sources import layout
from lectern.sources.articles import FILE, load_bronze, read_article_files, read_gold, read_inferred, read_silver

log = logging.getLogger(__name__)

BROADCAST_KEYS = 200_000


class Collector(Protocol):
    """A source of articles: where its files are, how they are checked, loaded and indexed."""

    def extract(self, day: str) -> str: ...

    def validate(self, rows: DataFrame) -> DataFrame: ...

    def load(self, day: str) -> dict[str, int]: ...

    def index(self, day: str) -> dict[str, int]: ...

    def process(self, day: str) -> dict[str, int]: ...


@dataclass
class ArticleCollector:
    """Bronze files of one topic (or all) to the silver and gold tables at ``root``."""

    spark: SparkSession
    root: str
    embedder: Embedder
    topic: str = "*"
    stamp: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))
    update_cols: tuple[str, ...] = UPDATE_PARTIAL
    on_violation: str = "warn"
    max_bad: int = MAX_BAD_RECORDS
    chunker: str = "whitespace"
    exclude_gated: bool = True
    index_by: str = "published"
    suffix: str = ".json"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold"

    @property
    def rejects(self) -> str:
        return f"{self.root}/rejects"

    def extract(self, day: str) -> str:
        """Folders are named plainly (``{topic}/{day}``) or by our own sink (``folder={topic}/run_date={day}``)."""
        topic = "*" if self.topic == "*" else f"{{,folder=}}{self.topic}"
        return f"{self.root}/{layout.ARTICLES}/{topic}/{{,run_date=}}{day}/*{self.suffix}"

    def validate(self, rows: DataFrame) -> DataFrame:
        return contract.violations(rows)

    def load(self, day: str) -> dict[str, int]:
        """Stage the day's files, check the contract, upsert. A day without files changes nothing.

        Records that cannot be read and rows that the policy holds back are written to the rejects of the day.
        """
        with Scratch(self.spark) as scratch:
            journal = Journal(self.spark, self.rejects, day)
            note = lambda load: journal.record("load", load.rejects, load.files, scratch)
            try:
                load = load_bronze(self.spark, self.extract(day), scratch, self.max_bad, self.suffix, note)
            except AnalysisException as e:
                if e.getCondition() != "PATH_NOT_FOUND":
                    raise
                log.warning("nothing landed on %s", day)
                return dict.fromkeys(("rows_loaded", "bad_records", "violations", "rows_merged", "silver_partitions"), 0)
            broken = {r["violation"]: r["rows"] for r in contract.report(self.validate(load.rows)).collect()}
            found = sum(broken.values())
            if found:
                log.warning("%d contract violations", found)
            kept, held = contract.apply_policy(load.placed_rows, self.on_violation)
            record = F.to_json(F.struct(*ARTICLE_COLUMNS)).alias("record")
            reasons = F.array_join(contract.broken_rules(), ", ").alias("reason")
            journal.record("contract", held.select(F.col(FILE).alias("file"), record, reasons), load.files, scratch)
            merge = merge_silver(
                self.spark, self.silver, kept.select(*derive.silver_columns(), ROW, TIE), scratch, self.update_cols
            )
        return {
            "rows_loaded": load.good,
            "bad_records": load.bad,
            "violations": found,
            "rows_merged": merge.source_rows,
            "silver_partitions": merge.partitions,
        }

    def index(self, day: str) -> dict[str, int]:
        touched = index_day(
            self.spark,
            self.silver,
            self.gold,
            day,
            self.embedder,
            self.stamp,
            self.index_by,
            chunker=self.chunker,
            exclude_gated=self.exclude_gated,
        )
        return {"gold_partitions": len(touched.parts)}

    def process(self, day: str) -> dict[str, int]:
        return {**self.load(day), **self.index(day)}


def land_pages(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    run_date: str,
    stamp: dt.datetime,
    rules: str = "canonical",
    few: int = BROADCAST_KEYS,
) -> dict[str, int]:
    """Extract pages ``url, topic, pos, html`` not landed yet today into bronze; failures go to errors.

    Of pages with the same topic and slug the first is taken, as the second would find the path
    taken. ``pos`` identifies a page. The choice is made on key columns and reaches the pages as a broadcast, of the
    positions chosen or, if more than ``few``, of a filter of them, so HTML is never shuffled. Pages are parsed once, into a stage that both outputs read.
    """
    landed = f"{root}/{layout.ARTICLES}"
    counts = Observation()
    with Scratch(spark) as scratch:
        chosen = scratch.write(_not_landed(spark, pages, landed, run_date).select("pos"))
        todo, exact = _only(pages, chosen, "pos", few)
        parsed = extract_articles(todo, stamp, rules, keep=("pos",))
        if not exact:  # some pages passed the filter by chance: what they gave is dropped
            parsed = scratch.write(parsed).join(chosen, "pos", "left_semi")
        done = scratch.write(
            parsed.drop("pos").observe(
                counts,
                F.count(F.lit(1)).alias("pages"),
                F.coalesce(F.sum(F.col("error").isNotNull().cast("long")), F.lit(0)).alias("errors"),
            )
        )
        articles, errors = split_errors(done)
        sinks.write_bronze(articles, landed, run_date)
        path = f"{root}/{layout.ERRORS}"
        if counts.get["errors"] or exists(spark, path):
            sinks.write_errors(errors, path, run_date, done.select("topic", F.col("article_url").alias("url")))
    return {"pages": counts.get["pages"], "errors": counts.get["errors"]}


def _not_landed(spark: SparkSession, pages: DataFrame, landed: str, run_date: str) -> DataFrame:
    """Keys of the pages to work on."""
    keys = pages.select("topic", F.lit(run_date).alias("run_date"), derive.url_slug("url").alias("slug"), "pos")
    first = first_landing(keys, "pos")
    if not exists(spark, landed):
        return first
    # Our own files name topic and slug in their rows, files of one article each in their path.
    rows = spark.read.schema("topic string, slug string").json(landed, recursiveFileLookup=True, pathGlobFilter="*.json")
    path = F.col("_metadata.file_path")
    present = rows.select(
        F.coalesce("topic", layout.path_topic(path)).alias("topic"),
        F.coalesce("slug", layout.path_stem(path)).alias("slug"),
        layout.path_run_date(path).alias("run_date"),
    )
    return skip_landed(first, present.where(F.col("run_date") == run_date))


def _only(rows: DataFrame, chosen: DataFrame, key: str, few: int) -> tuple[DataFrame, bool]:
    """Rows whose key was chosen, and whether these are exactly those: beyond a broadcast some more may be among them."""
    if chosen.count() <= few:  # numbers
        return rows.join(F.broadcast(chosen), key, "left_semi"), True
    return rows.where(in_filter(key, chosen)), False


def run_pipeline(
    spark: SparkSession,
    pages: DataFrame,
    root: str,
    run_date: str,
    embedder: Embedder,
    stamp: dt.datetime,
    **options: object,
) -> dict[str, int]:
    """One day from pages to searchable chunks; running it again gives the same tables."""
    landed = land_pages(spark, pages, root, run_date, stamp)
    collector = ArticleCollector(spark, root, embedder, stamp=stamp, **options)
    return {**landed, **collector.process(run_date)}


def load_files(
    spark: SparkSession, path: str, silver: str, update_cols: tuple[str, ...], rejects: str | None = None, run: str = "once"
) -> int:
    """Loader for one-document-per-file folders: unreadable files to ``rejects``, then an upsert. Returns rows merged."""
    with Scratch(spark) as scratch:
        articles, broken, files = read_article_files(spark, path, scratch)
        for row in broken.select("file_path").limit(5).collect():
            log.warning("not a JSON document: %s", row["file_path"])
        if rejects:
            named = broken.select(F.col("file_path").alias("file"), F.col("file_path").alias("record"), F.col("error").alias("reason"))
            Journal(spark, rejects, run).record("files", named, files, scratch)
        return merge_silver(spark, silver, articles.select(*derive.silver_columns()), scratch, update_cols).source_rows


def load_inferred(
    spark: SparkSession, path: str, silver: str, rejects: str | None = None, run: str = "once", suffix: str = ".json"
) -> int:
    """Loader that takes the types from the files. Returns rows merged.

    A load that fails, for whatever reason, is a warning and merges nothing. Lines that are not one record go to ``rejects``.
    """
    with Scratch(spark) as scratch:
        try:
            load = read_inferred(spark, path, scratch, suffix)
            if load is None:
                return 0
            if rejects:
                Journal(spark, rejects, run).record("inferred", load.rejects, load.files, scratch)
            if load.bad:
                log.warning("skipped %d bad records", load.bad)
            for row in contract.sample(contract.violations(load.rows)).collect():
                log.warning("contract violation: %s %s", row["article_url"], row["violation"])
            return merge_silver(spark, silver, load.placed_rows.select(*derive.silver_columns(), ROW, TIE), scratch).source_rows
        except (PySparkException, Py4JError, ConflictError) as e:
            log.warning("load failed: %s", e)
            return 0


def ask(
    spark: SparkSession,
    questions: DataFrame,
    root: str,
    embedder: Embedder,
    model: Callable[[], Callable[[list[str]], list[str]]],
    k: int = 3,
) -> DataFrame:
    """Answers to a table of questions from the gold table at ``root``."""
    return answer_questions(questions, read_gold(spark, f"{root}/gold"), embedder, model, k)


def skipped_by_index(spark: SparkSession, silver: str) -> int:
    """Articles no publication day can reach, because their date is null."""
    return read_silver(spark, silver).where(F.col("published_date").isNull()).count()
