"""Feed documents, URL lists and manifests as DataFrames."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.schemas import URL_LIST
from lectern.sources import layout
from lectern.sources.documents import one_document, whole_files

FEED = "channel struct<item: array<struct<link: string>>>, _corrupt_record string"

# Fixed value: error text of a feed without items.
EMPTY_FEED = "Feed empty or failed to parse"


#: Error text of a feed file whose path names no topic, and the topic its record gets.
MISPLACED = "Feed file outside the layout"
UNKNOWN_TOPIC = "unknown"
#: Items that one feed file may hold: a feed is one small document.
FILE_ITEMS = 1 << 32


def parse_feed(xml: Column) -> Column:
    """``rss`` document text to a struct; a broken document leaves only ``_corrupt_record``."""
    return F.from_xml(xml, FEED, {"rowTag": "rss", "mode": "PERMISSIVE"})


def read_feeds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``topic, run_date, xml``: one row per feed file. A feed is one small document."""
    files = whole_files(spark, path)
    return layout.with_path_columns(files).select(
        F.col("path_topic").alias("topic"),
        F.col("path_run_date").alias("run_date"),
        F.col("_metadata.file_path").alias("file"),
        F.col("value").alias("xml"),
    )


def number_files(found: DataFrame) -> DataFrame:
    """Feeds with ``base``, where the positions of a file's items begin: files of a topic and day by their names.

    Only names are numbered; a topic has a few feed files a day.
    """
    names = found.select("topic", "run_date", "file").distinct()
    place = F.row_number().over(Window.partitionBy("topic", "run_date").orderBy("file")) - 1
    numbered = names.withColumn("base", place.cast("long") * F.lit(FILE_ITEMS))
    return found.join(numbered, ["topic", "run_date", "file"])


def number_rows(links: DataFrame) -> DataFrame:
    """Links of several lists with one position for each, by their place in a list, then by URL."""
    same = Window.partitionBy("topic", "run_date", "pos").orderBy("url")
    return links.withColumn("pos", F.col("pos").cast("long") * F.lit(FILE_ITEMS) + F.row_number().over(same) - 1)


def feed_items(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """One row per item: the feed's other columns, ``pos`` in feed order and ``link`` (may be null).

    Feeds that carry ``base`` (see :func:`number_files`) count from there.
    """
    others = [c for c in feeds.columns if c not in (xml, "base")]
    items = parse_feed(F.col(xml))["channel"]["item"]
    based = [F.col("base")] if "base" in feeds.columns else []
    rows = feeds.select(*others, *based, F.posexplode(items).alias("pos", "__item"))
    pos = F.col("base") + F.col("pos") if based else F.col("pos")
    return rows.select(*others, pos.alias("pos"), F.col("__item.link").alias("link"))


def keep_links(items: DataFrame, link: str = "link") -> DataFrame:
    """Drop items without a link. Duplicates and query strings stay."""
    return items.where(F.col(link).isNotNull() & (F.col(link) != ""))


def empty_feeds(feeds: DataFrame, xml: str = "xml") -> DataFrame:
    """Feeds with no item, or that do not parse, as error rows ``..., error``."""
    others = [c for c in feeds.columns if c != xml]
    items = F.size(F.coalesce(parse_feed(F.col(xml))["channel"]["item"], F.array()))
    return feeds.where(items == 0).select(*others, F.lit(EMPTY_FEED).alias("error"))


def topics_without_links(topics: DataFrame, links: DataFrame) -> DataFrame:
    """Topics that were asked for and gave no link, as error rows."""
    return topics.join(links.select("topic").distinct(), "topic", "left_anti").withColumn("error", F.lit(EMPTY_FEED))


def explode_url_list(documents: DataFrame, default_topic: str = "unknown") -> DataFrame:
    """``topic, pos, url`` from URL-list documents; no ``urls`` gives no rows."""
    topic = F.coalesce(F.nullif(F.col("topic"), F.lit("")), F.lit(default_topic))
    keep = [c for c in documents.columns if c not in ("topic", "timestamp", "urls")]
    return documents.select(topic.alias("topic"), *keep, F.posexplode("urls").alias("pos", "url"))


def read_url_lists(
    spark: SparkSession, path: str | list[str], default_topic: str = "unknown", lines: bool = False
) -> DataFrame:
    """URL-list files: one document each, pretty-printed or not, or with ``lines`` one document per line.

    A path without files gives no rows; a file that is not one document fails the job.
    """
    try:
        if lines:
            documents = spark.read.schema(URL_LIST).option("mode", "FAILFAST").json(path)
        else:
            found = F.coalesce(one_document(F.col("value"), URL_LIST.simpleString()), _broken())
            documents = whole_files(spark, path).select(found.alias("d")).select("d.*")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], URL_LIST)
    return explode_url_list(documents, default_topic)


def _broken(text: str = "value") -> Column:
    return F.raise_error(F.concat(F.lit("not one JSON document: "), F.substring(text, 1, 80)))


def explode_manifest(df: DataFrame, text: str = "value") -> DataFrame:
    """Manifest texts (a bare JSON array of URLs) to ``pos, url`` rows in order; any other text fails the job."""
    others = [c for c in df.columns if c != text]
    urls = F.coalesce(one_document(F.col(text), "array<string>"), _broken(text))
    return df.select(*others, F.posexplode(urls).alias("pos", "url"))


def read_manifests(spark: SparkSession, path: str | list[str]) -> DataFrame:
    named = layout.with_path_columns(whole_files(spark, path)).select(
        F.col("path_topic").alias("topic"),
        F.col("path_run_date").alias("run_date"),
        F.col("path_stem").alias("manifest"),
        "value",
    )
    return explode_manifest(named)


def with_manual_fallback(feed_links: DataFrame, manual_links: DataFrame) -> DataFrame:
    """Feed links, plus the supplied list for every topic whose feed gave none."""
    # distinct first: the topic list is combined map-side, and is small enough to broadcast once measured
    missing = manual_links.join(feed_links.select("topic").distinct(), "topic", "left_anti")
    return feed_links.unionByName(missing.select(feed_links.columns))
