"""The driver tables seen as articles, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.derive import silver_columns
from lectern.operators.sizing import spread_small_scan
from lectern.schemas import ARTICLE_COLUMNS

DAY = "2026-01-05"
STAMP = "2026-03-01 00:00:00"
HASH_DIM = 64


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """``documents`` as bronze articles, with ``doc_id``; some lack a title, a date or a good URL."""
    d = spread_small_scan(table(spark, sf, "documents"))
    return d.selectExpr(
        "doc_id",
        "case when doc_id % 37 = 0 then concat('invalid-', doc_id)"
        " else concat('https://ex.example/', source, '/a-', doc_id, '?source=rss') end as article_url",
        "lang as topic",
        "case when doc_id % 41 = 0 then null when doc_id % 40 = 0 then '' else split_part(text, chr(10), 1) end as title",
        "source as author_name",
        "text as page_content",
        "split_part(text, chr(10), 1) as first_line",
        "case when doc_id % 43 = 0 then '01/01/2026' when doc_id % 47 = 0 then null"
        " else concat('2026-01-', lpad(cast(1 + doc_id % 28 as string), 2, '0'), 'T00:00:00Z') end as published_date",
        "concat(cast(doc_id % 9 as string), '.5k') as clap_count",
        "cast(doc_id % 120 as string) as comments_count",
        "cast(null as string) as hero_image_url",
        "cast(null as string) as author_avatar_url",
        "timestamp'2026-02-01 00:00:00' + make_interval(0,0,0,0,0,0,cast(doc_id as decimal(18,6))) as ingested_at",
        "sha2(text, 256) as content_hash",
        "length(text) < 200 as content_gated",
    )


ARTICLES_SQL = """
art AS (
  SELECT doc_id,
    CASE WHEN doc_id % 37 = 0 THEN concat('invalid-', doc_id)
         ELSE concat('https://ex.example/', source, '/a-', doc_id, '?source=rss') END AS article_url,
    lang AS topic,
    CASE WHEN doc_id % 41 = 0 THEN NULL WHEN doc_id % 40 = 0 THEN '' ELSE split_part(text, chr(10), 1) END AS title,
    source AS author_name, text AS page_content, split_part(text, chr(10), 1) AS first_line,
    CASE WHEN doc_id % 43 = 0 THEN '01/01/2026' WHEN doc_id % 47 = 0 THEN NULL
         ELSE concat('2026-01-', lpad(CAST(1 + doc_id % 28 AS varchar), 2, '0'), 'T00:00:00Z') END AS published_date,
    concat(CAST(doc_id % 9 AS varchar), '.5k') AS clap_count,
    CAST(doc_id % 120 AS varchar) AS comments_count,
    CAST(NULL AS varchar) AS hero_image_url, CAST(NULL AS varchar) AS author_avatar_url,
    timestamp '2026-02-01 00:00:00' + to_seconds(doc_id) AS ingested_at,
    sha256(text) AS content_hash, length(text) < 200 AS content_gated
  FROM documents)"""


def silver(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).select(*silver_columns())


SILVER_SQL = f"""{ARTICLES_SQL},
silver AS (
  SELECT article_url, topic, title, author_name, page_content, first_line,
    CAST(try_strptime(split_part(published_date, 'T', 1), '%Y-%m-%d') AS date) AS published_date,
    clap_count, comments_count, hero_image_url, author_avatar_url, ingested_at, content_hash, content_gated
  FROM art)"""

COLUMNS_SQL = ", ".join(ARTICLE_COLUMNS)


def _simple(df: DataFrame, url: str, topic: str, text: str, stamp: str) -> DataFrame:
    """Another driver table as silver articles."""
    return df.selectExpr(
        f"{url} as article_url",
        f"'{topic}' as topic",
        f"split_part({text}, chr(10), 1) as title",
        f"'{topic}' as author_name",
        f"{text} as page_content",
        f"split_part({text}, chr(10), 1) as first_line",
        "date'2026-01-05' as published_date",
        "cast(null as string) as clap_count",
        "cast(null as string) as comments_count",
        "cast(null as string) as hero_image_url",
        "cast(null as string) as author_avatar_url",
        f"timestamp'{stamp}' as ingested_at",
        f"sha2({text}, 256) as content_hash",
        f"length({text}) < 200 as content_gated",
    )


def _simple_sql(name: str, url: str, topic: str, text: str, stamp: str) -> str:
    return f"""
  SELECT {url} AS article_url, '{topic}' AS topic, split_part({text}, chr(10), 1) AS title, '{topic}' AS author_name,
    {text} AS page_content, split_part({text}, chr(10), 1) AS first_line, date '2026-01-05' AS published_date,
    CAST(NULL AS varchar) AS clap_count, CAST(NULL AS varchar) AS comments_count,
    CAST(NULL AS varchar) AS hero_image_url, CAST(NULL AS varchar) AS author_avatar_url,
    timestamp '{stamp}' AS ingested_at, sha256({text}) AS content_hash, length({text}) < 200 AS content_gated
  FROM {name}"""


_BENCH = ("concat('https://ex.example/benchmark/', item_id)", "benchmark", "text", "2026-01-20 00:00:00")
_PAGE = ("url", "pages", "html", "2026-02-20 00:00:00")


def target(spark: SparkSession, sf: str) -> DataFrame:
    """A silver table before an upsert: all documents, and all benchmark texts."""
    return silver(spark, sf).unionByName(_simple(table(spark, sf, "benchmark"), *_BENCH))


def source(spark: SparkSession, sf: str) -> DataFrame:
    """A load to upsert: all documents seen again with new values, and all pages, which are new.

    Seen again later, a third of the documents has moved to the first of the month.
    """
    again = silver(spark, sf).selectExpr(
        "article_url",
        "concat(topic, '-x') as topic",
        "title",
        "concat(author_name, '-x') as author_name",
        "page_content",
        "first_line",
        "case when day(published_date) % 3 = 0 then date'2026-01-01' else published_date end as published_date",
        "'9k' as clap_count",
        "comments_count",
        "hero_image_url",
        "author_avatar_url",
        "ingested_at + interval 30 days as ingested_at",
        "case when topic = 'fr' then md5(page_content) else content_hash end as content_hash",
        "content_gated",
    )
    return again.unionByName(_simple(table(spark, sf, "pages"), *_PAGE))


UPSERT_SQL = f"""{SILVER_SQL},
tgt AS (SELECT {COLUMNS_SQL} FROM silver UNION ALL {_simple_sql("benchmark", *_BENCH)}),
src AS (
  SELECT article_url, concat(topic, '-x') AS topic, title, concat(author_name, '-x') AS author_name, page_content,
    first_line,
    CASE WHEN day(published_date) % 3 = 0 THEN date '2026-01-01' ELSE published_date END AS published_date,
    '9k' AS clap_count, comments_count, hero_image_url, author_avatar_url,
    ingested_at + interval 30 days AS ingested_at,
    CASE WHEN topic = 'fr' THEN md5(page_content) ELSE content_hash END AS content_hash, content_gated
  FROM silver
  UNION ALL {_simple_sql("pages", *_PAGE)})"""


def merged_sql(update: tuple[str, ...]) -> str:
    """Select list and join of an upsert of ``src`` into ``tgt``."""
    columns = []
    for c in ARTICLE_COLUMNS:
        if c == "article_url":
            columns.append("coalesce(s.article_url, t.article_url) AS article_url")
        elif c in update:
            columns.append(f"CASE WHEN s.article_url IS NOT NULL THEN s.{c} ELSE t.{c} END AS {c}")
        else:
            columns.append(f"CASE WHEN t.article_url IS NOT NULL THEN t.{c} ELSE s.{c} END AS {c}")
    return f"SELECT {', '.join(columns)} FROM tgt t FULL JOIN src s ON t.article_url = s.article_url"


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("question_id"), F.col("text").alias("query"))


# Chunks of open silver articles, in SQL: one row per chunk with its position from 0.
CHUNKS_SQL = """
cut AS (
  SELECT article_url, title, content_hash, published_date,
    regexp_extract_all(page_content, '[^\\n]{1,800}(?:\\s|$)') AS pieces
  FROM silver WHERE NOT content_gated),
chunks AS (
  SELECT article_url, title, published_date, concat(content_hash, '_chunk_', i - 1) AS chunk_id,
    pieces[i] AS chunk_text
  FROM (SELECT *, unnest(range(1, len(pieces) + 1)) AS i FROM cut))"""


def vectors_sql(name: str, rows: str, ids: str, text: str) -> str:
    """CTE ``name``: ``ids`` and the hashed vector ``v`` of ``text`` for every row of ``rows``."""
    join = " AND ".join(f"n.{c.strip()} = r.{c.strip()}" for c in ids.split(","))
    kept = ", ".join(f"r.{c.strip()}" for c in ids.split(","))
    return f"""
{name}_tok AS (
  SELECT {ids}, unnest(regexp_extract_all(
    translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\t\\n\\f\\r ]+')) AS tok
  FROM {rows}),
{name}_cnt AS (
  SELECT {ids}, CAST(concat('0x', substring(md5(tok), 1, 4)) AS bigint) % {HASH_DIM} AS b,
    CAST(count(*) AS double) AS c
  FROM {name}_tok GROUP BY ALL),
{name}_map AS (SELECT {ids}, map(list(b), list(c)) AS m, sqrt(sum(c * c)) AS n FROM {name}_cnt GROUP BY {ids}),
{name} AS (
  SELECT {kept}, list_transform(range({HASH_DIM}), lambda x: coalesce(n.m[x], 0.0) / coalesce(n.n, 1.0)) AS v
  FROM {rows} r LEFT JOIN {name}_map n ON {join})"""


def vector_text(column: str) -> Column:
    """A vector as text, in millionths."""
    return F.array_join(F.transform(column, lambda w: F.round(w * 1_000_000).cast("long").cast("string")), " ")


def vector_text_sql(column: str) -> str:
    return f"array_to_string(list_transform({column}, lambda x: CAST(round(x * 1000000) AS bigint)), ' ')"


HITS_SQL = f"""{SILVER_SQL},{CHUNKS_SQL},
asked AS (SELECT item_id AS question_id, text AS query FROM benchmark),
{vectors_sql("bv", "chunks", "chunk_id, article_url", "chunk_text")},
{vectors_sql("qv", "asked", "question_id", "query")},
scored AS (
  SELECT question_id, chunk_id, article_url, round(list_distance(qv.v, bv.v), 9) AS distance FROM qv, bv),
hits AS (
  SELECT question_id, rank, distance, chunk_id, article_url, chunk_text, title
  FROM (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY distance, chunk_id, article_url) AS rank
        FROM scored)
  JOIN chunks USING (chunk_id, article_url)
  WHERE rank <= 3)"""
