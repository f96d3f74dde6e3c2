"""Derived columns, chunking and the data contract on the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import derive
from lectern.operators import chunking, contract
from lectern.operators.sizing import spread_small_scan
from lectern.registry import register
from lectern.registry.views import (
    ARTICLES_SQL,
    COLUMNS_SQL,
    DAY,
    SILVER_SQL,
    articles,
    silver,
    table,
)


@register(
    "content_hash",
    "SELECT doc_id, sha256(text) AS sha256_hash, md5(text) AS md5_hash FROM documents",
)
def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        derive.content_hash("text").alias("sha256_hash"),
        derive.content_hash("text", "md5").alias("md5_hash"),
    )


@register(
    "gate_flag",
    "SELECT doc_id, coalesce(length(text), 0) < 200 AS gated, coalesce(length(trim(text)), 0) < 200 AS gated_trimmed"
    " FROM documents",
)
def gate_flag(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        "doc_id",
        derive.gate_flag("text").alias("gated"),
        derive.gate_flag("text", trimmed=True).alias("gated_trimmed"),
    )


@register(
    "url_slug",
    "SELECT page_id, coalesce(nullif(list_last(string_split(split_part(url, '?', 1), '/')), ''), md5(url)) AS slug"
    " FROM pages",
)
def url_slug(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", derive.url_slug("url").alias("slug"))


@register(
    "date_normalize",
    f"WITH {ARTICLES_SQL} SELECT doc_id, CAST(try_strptime(split_part(published_date, 'T', 1), '%Y-%m-%d') AS date)"
    " AS published_day FROM art",
)
def date_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", derive.parse_date("published_date").alias("published_day"))


@register(
    "date_text",
    f"WITH {ARTICLES_SQL} SELECT doc_id, split_part(published_date, 'T', 1) AS published_text FROM art",
)
def date_text(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", derive.date_text("published_date").alias("published_text"))


@register("silver_projection", f"WITH {SILVER_SQL} SELECT {COLUMNS_SQL} FROM silver")
def silver_projection(spark: SparkSession, sf: str) -> DataFrame:
    return silver(spark, sf)


@register(
    "prepared_document",
    f"""WITH {SILVER_SQL}
SELECT article_url, concat('Title: ', coalesce(title, 'Untitled'), chr(10), 'Author: ',
  coalesce(author_name, 'Unknown'), chr(10), 'Date: ', coalesce(CAST(published_date AS varchar), '{DAY}'), chr(10),
  'URL: ', coalesce(article_url, ''), chr(10), chr(10), coalesce(page_content, '')) AS text_content
FROM silver WHERE content_gated = FALSE""",
)
def prepared_document(spark: SparkSession, sf: str) -> DataFrame:
    open_rows = silver(spark, sf).where(chunking.open_articles())
    return open_rows.select("article_url", derive.prepared_document(DAY).alias("text_content"))


@register(
    "metadata_defaults",
    f"""WITH {ARTICLES_SQL}
SELECT doc_id, article_url AS source, coalesce(nullif(title, ''), 'Unknown') AS title,
  coalesce(nullif(author_name, ''), 'Unknown') AS author FROM art""",
)
def metadata_defaults(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select("doc_id", derive.chunk_metadata().alias("m")).select("doc_id", "m.*")


_GATES = "CASE WHEN topic = 'de' THEN NULL ELSE content_gated END"


@register(
    "gate_filter",
    f"WITH {ARTICLES_SQL}, g AS (SELECT doc_id, {_GATES} AS content_gated FROM art)"
    " SELECT doc_id FROM g WHERE content_gated = FALSE",
)
def gate_filter(spark: SparkSession, sf: str) -> DataFrame:
    flags = articles(spark, sf).selectExpr("doc_id", f"{_GATES} as content_gated")
    return flags.where(chunking.open_articles()).select("doc_id")


@register(
    "gate_filter_truthy",
    f"WITH {ARTICLES_SQL}, g AS (SELECT doc_id, {_GATES} AS content_gated FROM art)"
    " SELECT doc_id FROM g WHERE NOT coalesce(content_gated, FALSE)",
)
def gate_filter_truthy(spark: SparkSession, sf: str) -> DataFrame:
    flags = articles(spark, sf).selectExpr("doc_id", f"{_GATES} as content_gated")
    return flags.where(chunking.open_articles(keep_unknown=True)).select("doc_id")


@register(
    "day_scan",
    f"WITH {SILVER_SQL} SELECT article_url, topic, published_date FROM silver WHERE published_date = date '{DAY}'",
)
def day_scan(spark: SparkSession, sf: str) -> DataFrame:
    from lectern.sources.articles import published_on

    return published_on(silver(spark, sf), DAY).select("article_url", "topic", "published_date")


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread_small_scan(table(spark, sf, "documents").select("doc_id", F.col("text").alias("page_content")))


@register(
    "chunk_whitespace",
    """WITH c AS (SELECT doc_id, regexp_extract_all(text, '[^\\n]{1,800}(?:\\s|$)') AS l FROM documents)
SELECT doc_id, CAST(i - 1 AS integer) AS chunk_index, l[i] AS chunk_text
FROM (SELECT *, unnest(range(1, len(l) + 1)) AS i FROM c)""",
)
def chunk_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_whitespace(_documents(spark, sf)).drop("page_content")


@register(
    "chunk_fixed",
    f"""WITH {ARTICLES_SQL}
SELECT doc_id, concat(coalesce(nullif(content_hash, ''), md5(article_url)), '_chunk_', i) AS chunk_id,
  substring(page_content, CAST(i * 3000 + 1 AS bigint), 3000) AS chunk_text, article_url AS source,
  coalesce(nullif(title, ''), 'Unknown') AS title, coalesce(nullif(author_name, ''), 'Unknown') AS author
FROM (SELECT *, unnest(range(0, CAST(ceil(length(page_content) / 3000.0) AS bigint))) AS i FROM art
      WHERE NOT coalesce(content_gated, FALSE))""",
)
def chunk_fixed(spark: SparkSession, sf: str) -> DataFrame:
    rows = chunking.article_chunks(articles(spark, sf), "fixed", keep_unknown_gate=True)
    return rows.withColumn("m", derive.chunk_metadata()).select("doc_id", "chunk_id", "chunk_text", "m.*")


@register(
    "chunk_token_window",
    """WITH t AS (SELECT doc_id, regexp_extract_all(text, '[^\\t\\n\\f\\r ]+') AS l FROM documents)
SELECT doc_id, CAST(i AS integer) AS chunk_index,
  array_to_string(l[i * 896 + 1 : i * 896 + 1024], ' ') AS chunk_text
FROM (SELECT *, unnest(range(0, greatest(1, CAST(ceil((len(l) - 128) / 896.0) AS bigint)))) AS i
      FROM t WHERE len(l) > 0)""",
)
def chunk_token_window(spark: SparkSession, sf: str) -> DataFrame:
    return chunking.chunk_tokens(_documents(spark, sf)).drop("page_content")


_BULK_SQL = f"""WITH {ARTICLES_SQL},
v AS (
  SELECT article_url, unnest(list_filter([
    CASE WHEN length(page_content) < 200 THEN 'Content too short' END,
    CASE WHEN coalesce(title, '') = '' THEN 'Missing title' END,
    CASE WHEN NOT starts_with(article_url, 'http') THEN 'Invalid URL' END], lambda x: x IS NOT NULL)) AS violation
  FROM art)"""


@register("contract_bulk", f"{_BULK_SQL} SELECT article_url, violation FROM v")
def contract_bulk(spark: SparkSession, sf: str) -> DataFrame:
    return contract.violations(articles(spark, sf))


@register(
    "contract_strict",
    f"""WITH {ARTICLES_SQL},
r AS (SELECT doc_id, article_url, title, page_content, split_part(published_date, 'T', 1) AS d FROM art)
SELECT doc_id, CASE
  WHEN coalesce(article_url, '') = '' THEN 'Missing required field: article_url'
  WHEN coalesce(title, '') = '' THEN 'Missing required field: title'
  WHEN coalesce(page_content, '') = '' THEN 'Missing required field: page_content'
  WHEN coalesce(d, '') = '' THEN 'Missing required field: published_date'
  WHEN length(page_content) < 200 THEN
    concat('Article content too short (', length(page_content), ' chars). Likely gated or failed scrape.')
  WHEN NOT starts_with(article_url, 'http') THEN concat('Invalid article URL: ', article_url)
  WHEN try_strptime(d, '%Y-%m-%d') IS NULL THEN concat('Invalid date format: ', d, '. Expected YYYY-MM-DD.')
  END AS violation FROM r""",
)
def contract_strict(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = articles(spark, sf).withColumn("published_date", derive.date_text("published_date"))
    return contract.validate_records(cleaned).select("doc_id", "violation")


@register("contract_report", f'{_BULK_SQL} SELECT violation, count(*) AS "rows" FROM v GROUP BY violation')
def contract_report(spark: SparkSession, sf: str) -> DataFrame:
    return contract.report(contract.violations(articles(spark, sf)))


@register(
    "contract_sample",
    f"{_BULK_SQL} SELECT article_url, violation FROM v ORDER BY article_url, violation LIMIT 5",
)
def contract_sample(spark: SparkSession, sf: str) -> DataFrame:
    return contract.sample(contract.violations(articles(spark, sf)))


@register(
    "contract_quarantine",
    f"""{_BULK_SQL}
SELECT doc_id, article_url, CASE WHEN article_url IN (SELECT article_url FROM v) THEN 'held' ELSE 'merged' END AS state
FROM art""",
)
def contract_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    kept, held = contract.apply_policy(articles(spark, sf), "quarantine")
    return kept.select("doc_id", "article_url", F.lit("merged").alias("state")).unionByName(
        held.select("doc_id", "article_url", F.lit("held").alias("state"))
    )
