"""Feeds, URL lists and article extraction on the pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.blocks import with_blocks
from lectern.operators.extract import extract_articles
from lectern.operators.sizing import spread_small_scan
from lectern.plans import sinks
from lectern.registry import register
from lectern.registry.views import DAY, STAMP, table
from lectern.scratch import Scratch
from lectern.sources import feeds
from lectern.sources.documents import whole_files

_TOPIC = "^https?://[^/]+/([^/?#]*)"
_FEED_ITEMS = 25


def _links(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select(
        F.regexp_extract("url", _TOPIC, 1).alias("topic"), F.col("page_id").alias("pos"), "url"
    )


def _feeds(spark: SparkSession, sf: str) -> DataFrame:
    """Feed documents of 25 pages each; pages with a query string are followed by an item without a link."""
    escaped = F.replace(F.col("url"), F.lit("&"), F.lit("&amp;"))
    item = F.concat(
        F.lit("<item><title>t</title><link>"),
        escaped,
        F.lit("</link></item>"),
        F.when(F.contains("url", F.lit("?")), F.lit("<item><title>no link</title></item>")).otherwise(F.lit("")),
    )
    rows = table(spark, sf, "pages").select(
        F.floor(F.col("page_id") / _FEED_ITEMS).alias("feed_id"), F.struct("page_id", item.alias("item")).alias("i")
    )
    grouped = rows.groupBy("feed_id").agg(F.array_sort(F.collect_list("i")).alias("items"))
    body = F.array_join(F.transform("items", lambda i: i["item"]), "")
    return grouped.select(
        "feed_id",
        F.concat(F.lit("<rss version='2.0'><channel><title>f</title>"), body, F.lit("</channel></rss>")).alias("xml"),
    )


@register(
    "feed_links",
    f"""WITH p AS (SELECT page_id // {_FEED_ITEMS} AS feed_id, page_id, url,
  1 + CAST(contains(url, '?') AS integer) AS items FROM pages)
SELECT feed_id, CAST(coalesce(sum(items) OVER (PARTITION BY feed_id ORDER BY page_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS integer) AS pos, url AS link FROM p""",
)
def feed_links(spark: SparkSession, sf: str) -> DataFrame:
    return feeds.keep_links(feeds.feed_items(_feeds(spark, sf)))


@register(
    "feed_empty_topics",
    f"""WITH t AS (SELECT DISTINCT lang AS topic FROM documents UNION SELECT DISTINCT source FROM documents)
SELECT topic, 'Feed empty or failed to parse' AS error FROM t
WHERE topic NOT IN (SELECT regexp_extract(url, '{_TOPIC}', 1) FROM pages)""",
)
def feed_empty_topics(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    wanted = documents.select(F.explode(F.array("lang", "source")).alias("topic")).distinct()
    return feeds.topics_without_links(wanted, _links(spark, sf))


@register(
    "url_list",
    f"""SELECT topic, CAST((row_number() OVER (PARTITION BY topic ORDER BY page_id) - 1) % 20 AS integer) AS pos, url
FROM (SELECT regexp_extract(url, '{_TOPIC}', 1) AS topic, page_id, url FROM pages)""",
)
def url_list(spark: SparkSession, sf: str) -> DataFrame:
    scratch = Scratch(spark)
    path = scratch.path("topic-urls")
    sinks.write_url_lists(_links(spark, sf), path, DAY, F.lit(STAMP), size=20)
    back = feeds.read_url_lists(spark, path, lines=True)
    return back.select("topic", "pos", "url")


_BLOCKS_SQL = f"""
WITH l AS (SELECT regexp_extract(url, '{_TOPIC}', 1) AS topic, page_id, url FROM pages),
n AS (SELECT topic, url, row_number() OVER (PARTITION BY topic ORDER BY page_id) - 1 AS position FROM l)"""


@register(
    "url_blocks",
    f"{_BLOCKS_SQL} SELECT topic, url, position, CAST(position // 20 AS bigint) AS block_id FROM n",
)
def url_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return with_blocks(_links(spark, sf), ["topic"], "pos", size=20).drop("pos")


@register(
    "manifest_blocks",
    f"""{_BLOCKS_SQL} SELECT topic, '{DAY}' AS run_date, CAST(position // 20 AS integer) AS block_id,
  CAST(position % 20 AS integer) AS pos, url FROM n""",
)
def manifest_blocks(spark: SparkSession, sf: str) -> DataFrame:
    scratch = Scratch(spark)
    path = scratch.path("manifests")
    sinks.write_manifests(_links(spark, sf).withColumn("run_date", F.lit(DAY)), path, size=20)
    files = whole_files(spark, path)
    rows = feeds.explode_manifest(files.select("value", "topic", F.col("run_date").cast("string"), "block_id"))
    return rows.select("topic", "run_date", "block_id", "pos", "url")


@register(
    "manual_fallback",
    f"""WITH feed AS (SELECT regexp_extract(url, '{_TOPIC}', 1) AS topic, url FROM pages),
manual AS (SELECT lang AS topic, concat('https://ex.example/', doc_id) AS url FROM documents
           UNION ALL SELECT source, concat('https://ex.example/', doc_id) FROM documents)
SELECT topic, url FROM feed
UNION ALL SELECT topic, url FROM manual WHERE topic NOT IN (SELECT topic FROM feed)""",
)
def manual_fallback(spark: SparkSession, sf: str) -> DataFrame:
    manual = table(spark, sf, "documents").select(
        F.explode(F.array("lang", "source")).alias("topic"),
        F.concat(F.lit("https://ex.example/"), F.col("doc_id").cast("string")).alias("url"),
    )
    return feeds.with_manual_fallback(_links(spark, sf).drop("pos"), manual)


def _decoded(text: str) -> str:
    """SQL for the two entities the articles use; HTML reads them also without their semicolon."""
    return f"""regexp_replace(regexp_replace({text}, '&quot;?', '"', 'g'), '&amp;?', '&', 'g')"""


# The pages keep their paragraphs regular enough for SQL: one article, paragraphs that start with
# <p> and may be left open.
_PAGE_SQL = f"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1) AS body FROM pages),
p AS (SELECT page_id, url, body,
  list_transform(string_split(body, '<p>')[2:], lambda x: trim({_decoded("regexp_replace(x, '<[^>]*>', '', 'g')")},
    concat(' ', chr(9), chr(10), chr(13)))) AS ps FROM a),
x AS (SELECT page_id, url, regexp_extract(url, '{_TOPIC}', 1) AS topic,
  trim({_decoded("regexp_extract(body, '<h1>([^<]*)</h1>', 1)")}) AS title,
  trim(array_to_string(ps, chr(10) || chr(10)), concat(' ', chr(10))) AS page_content,
  nullif(ps[1], '') AS first_line FROM p)"""


def _extracted(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread_small_scan(table(spark, sf, "pages").select("url", "html"))
    named = pages.withColumn("topic", F.regexp_extract("url", _TOPIC, 1))
    return extract_articles(named, F.lit(STAMP).cast("timestamp"))


@register("extract_title", f"{_PAGE_SQL} SELECT url AS article_url, title FROM x")
def extract_title(spark: SparkSession, sf: str) -> DataFrame:
    return _extracted(spark, sf).select("article_url", "title")


@register(
    "extract_articles",
    f"""{_PAGE_SQL}
SELECT url AS article_url, topic, title, '' AS author_name, page_content, first_line,
  CAST(NULL AS varchar) AS published_date, CAST(NULL AS varchar) AS clap_count,
  CAST(NULL AS varchar) AS comments_count, CAST(NULL AS varchar) AS hero_image_url,
  CAST(NULL AS varchar) AS author_avatar_url, timestamp '{STAMP}' AS ingested_at,
  sha256(page_content) AS content_hash, length(page_content) < 200 AS content_gated, CAST(NULL AS varchar) AS error
FROM x""",
)
def extract_fields(spark: SparkSession, sf: str) -> DataFrame:
    return _extracted(spark, sf)


@register(
    "extract_legacy",
    f"""WITH t AS (SELECT url, trim({_decoded("""regexp_replace(regexp_extract(
  html, '(?s)<article[^>]*>(.*)</article>', 1), '<[^>]*>', '', 'g')""")}) AS body FROM pages)
SELECT url AS article_url, nullif(body, '') AS page_content, md5(body) AS content_hash, length(body) < 200
  AS content_gated FROM t""",
)
def extract_legacy(spark: SparkSession, sf: str) -> DataFrame:
    pages = spread_small_scan(table(spark, sf, "pages").select("url", "html")).withColumn("topic", F.lit("t"))
    found = extract_articles(pages, F.lit(STAMP).cast("timestamp"), rules="legacy")
    return found.select("article_url", "page_content", "content_hash", "content_gated")
