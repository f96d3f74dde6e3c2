"""Whole jobs: land, load, index, ask."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.embedding import HashingEmbedder
from lectern.plans import pipeline, sinks
from lectern.registry import register
from lectern.registry.views import (
    ARTICLES_SQL,
    CHUNKS_SQL,
    DAY,
    HASH_DIM,
    SILVER_SQL,
    STAMP,
    articles,
    table,
    vector_text,
    vector_text_sql,
    vectors_sql,
)
from lectern.schemas import ARTICLE_COLUMNS
from lectern.scratch import Scratch
from lectern.sources import layout
from lectern.sources.articles import read_gold

STAMP_TIME = dt.datetime.fromisoformat(STAMP)


def _landed(spark: SparkSession, sf: str) -> str:
    root = Scratch(spark).path("lake")
    sinks.write_bronze(articles(spark, sf).select(*ARTICLE_COLUMNS), f"{root}/{layout.ARTICLES}", DAY)
    return root


def _collector(spark: SparkSession, root: str) -> pipeline.ArticleCollector:
    return pipeline.ArticleCollector(spark, root, HashingEmbedder(HASH_DIM), stamp=STAMP_TIME)


@register(
    "pipeline_metrics",
    f"""WITH {ARTICLES_SQL}, {SILVER_SQL.split("FROM documents),", 1)[1]}
SELECT 'rows_loaded' AS metric, count(*) AS amount FROM art
UNION ALL SELECT 'bad_records', 0
UNION ALL SELECT 'violations', count(*) FILTER (WHERE length(page_content) < 200)
  + count(*) FILTER (WHERE title IS NULL OR title = '') + count(*) FILTER (WHERE NOT article_url LIKE 'http%') FROM art
UNION ALL SELECT 'rows_merged', count(DISTINCT article_url) FROM art
UNION ALL SELECT 'silver_partitions', count(DISTINCT coalesce(published_date, date '1900-01-01')) FROM silver
UNION ALL SELECT 'gold_partitions', 1""",
)
def pipeline_metrics(spark: SparkSession, sf: str) -> DataFrame:
    counts = _collector(spark, _landed(spark, sf)).process(DAY)
    return spark.createDataFrame(list(counts.items()), "metric string, amount long")


@register(
    "pipeline_rerun",
    f"""WITH {SILVER_SQL},{CHUNKS_SQL}, day AS (SELECT * FROM chunks WHERE published_date = date '{DAY}'),
{vectors_sql("gv", "day", "chunk_id, article_url", "chunk_text")}
SELECT article_url, chunk_id, chunk_text, {vector_text_sql("v")} AS embedding, timestamp '{STAMP}' AS ingested_at
FROM day JOIN gv USING (chunk_id, article_url)""",
)
def pipeline_rerun(spark: SparkSession, sf: str) -> DataFrame:
    """The day processed twice leaves the gold table of one run."""
    collector = _collector(spark, _landed(spark, sf))
    for _ in range(2):
        collector.process(DAY)
    return read_gold(spark, collector.gold).select("article_url", "chunk_id", "chunk_text", vector_text("embedding").alias("embedding"), "ingested_at")


@register(
    "land_pages",
    """WITH c AS (SELECT page_id, url, regexp_extract(url, '^https?://[^/]+/([^/?#]*)', 1) AS topic,
  coalesce(nullif(list_last(string_split(split_part(url, '?', 1), '/')), ''), md5(url)) AS slug FROM pages)
SELECT url AS article_url, topic, slug FROM (
  SELECT *, row_number() OVER (PARTITION BY topic, slug ORDER BY page_id) AS rn FROM c) WHERE rn = 1""",
)
def land_pages(spark: SparkSession, sf: str) -> DataFrame:
    """All pages landed, then all again: the second run finds every path taken."""
    root = Scratch(spark).path("lake")
    pages = table(spark, sf, "pages").select(
        F.col("page_id").alias("pos"),
        "url",
        F.regexp_extract("url", "^https?://[^/]+/([^/?#]*)", 1).alias("topic"),
        "html",
    )
    for _ in range(2):
        pipeline.land_pages(spark, pages, root, DAY, STAMP_TIME)
    back = spark.read.schema("article_url string, topic string, slug string").json(f"{root}/{layout.ARTICLES}")
    return back.select("article_url", "topic", "slug")
