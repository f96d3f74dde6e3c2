"""What a load keeps out, fields of pages with every kind of markup, and models of the user's own."""

from __future__ import annotations

import contextlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.functions.embedding import FunctionEmbedder, HashingEmbedder, embed
from lectern.operators.chunking import article_chunks
from lectern.operators.extract import extract_articles
from lectern.operators.sizing import spread_small_scan
from lectern.plans import pipeline
from lectern.registry import SQL, register
from lectern.registry.jobs import STAMP_TIME
from lectern.registry.views import ARTICLES_SQL, CHUNKS_SQL, DAY, HASH_DIM, SILVER_SQL, STAMP, articles, silver, table
from lectern.schemas import ARTICLE_COLUMNS, BRONZE_ARTICLE, ERROR_RECORD
from lectern.scratch import Scratch
from lectern.sources import layout
from lectern.plans.journal import Journal
from lectern.sources.articles import BadRecordLimitError, read_silver


# How each topic is loaded: by the declared loader, by the inferring one, or with a limit that its bad lines exceed.
_DECLARED, _INFERRED, _REFUSED = ("en", "fr"), "es", "de"


@register(
    "rejects",
    f"""WITH {ARTICLES_SQL},
lines AS (
  SELECT *, CASE WHEN doc_id % 7 = 0 THEN 'two' WHEN doc_id % 11 = 0 THEN 'cut' WHEN doc_id % 13 = 0 THEN 'key' ELSE 'good' END AS kind
  FROM art WHERE topic IN ('en', 'fr', 'es', 'de')),
rules AS (SELECT *, topic IN ('en', 'fr') AS declared, list_filter([CASE WHEN length(page_content) < 200 THEN 'Content too short' END,
    CASE WHEN title IS NULL OR title = '' THEN 'Missing title' END,
    CASE WHEN NOT article_url LIKE 'http%' THEN 'Invalid URL' END], lambda x: x IS NOT NULL) AS broken FROM lines)
SELECT CASE WHEN topic = 'es' THEN 'inferred' ELSE 'load' END AS step, topic,
  CASE kind WHEN 'key' THEN 'no article_url' ELSE 'not one JSON record' END AS reason, count(*) AS n
FROM rules WHERE kind <> 'good' GROUP BY ALL
UNION ALL SELECT 'contract', topic, array_to_string(broken, ', '), count(*) FROM rules WHERE kind = 'good' AND declared AND len(broken) > 0 GROUP BY ALL
UNION ALL SELECT 'kept', topic, 'silver', count(*) FROM rules
  WHERE kind = 'good' AND ((declared AND len(broken) = 0) OR topic = 'es') GROUP BY ALL""",
)
def rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Topics loaded one after the other, some again, by both loaders, one past its limit: each line that was loaded is in
    silver or recorded, once, and all lines of the load that was refused that no loader could read are recorded too."""
    root = Scratch(spark).path("lake")
    line = F.to_json(F.struct(*ARTICLE_COLUMNS))
    lines = articles(spark, sf).select(
        F.when(F.expr("doc_id % 7 = 0"), F.concat(line, F.lit(" "), line))
        .when(F.expr("doc_id % 11 = 0"), F.concat(F.lit("{"), line))
        .when(F.expr("doc_id % 13 = 0"), F.to_json(F.struct("topic", "title")))
        .otherwise(line)
        .alias("value"),
        F.col("topic").alias("folder"),
        F.lit(DAY).alias("run_date"),
    )
    lines.write.partitionBy("folder", "run_date").text(f"{root}/{layout.ARTICLES}")

    def collector(topic: str, max_bad: int = 1 << 40) -> pipeline.ArticleCollector:
        embedder = HashingEmbedder(HASH_DIM)
        return pipeline.ArticleCollector(spark, root, embedder, topic, stamp=STAMP_TIME, on_violation="quarantine", max_bad=max_bad, suffix=".txt")

    for topic in (*_DECLARED, _DECLARED[0]):
        collector(topic).load(DAY)
    inferred = collector(_INFERRED)
    for _ in range(2):
        pipeline.load_inferred(spark, inferred.extract(DAY), inferred.silver, inferred.rejects, DAY, ".txt")
    with contextlib.suppress(BadRecordLimitError):
        collector(_REFUSED, max_bad=0).load(DAY)
    recorded = Journal(spark, inferred.rejects, DAY).read().select("step", "topic", "reason")
    kept = read_silver(spark, inferred.silver).select(F.lit("kept").alias("step"), "topic", F.lit("silver").alias("reason"))
    return recorded.unionByName(kept).groupBy("step", "topic", "reason").agg(F.count("*").alias("n"))


def _marked_up(spark: SparkSession, sf: str) -> DataFrame:
    """A page per document: which of the tags it has follows from its id."""
    d = spread_small_scan(table(spark, sf, "documents").select("doc_id", "lang", "source"))
    parts = (
        "'<html><head>'",
        """if(doc_id % 2 = 0, concat('<meta content="T', doc_id, '" property="og:title">'), '<meta property="og:title" content="">')""",
        """case doc_id % 3 when 0 then concat('<meta name="author" content="A', source, '">') when 1 then '<meta name="author">' else '' end""",
        """if(doc_id % 4 = 0, concat('<meta property="article:published_time" content="2026-01-0', 1 + doc_id % 9, 'T00:00:00Z">'), '')""",
        """if(doc_id % 5 = 0, concat('<meta property="og:image" content="http://i/', doc_id, '.png">'), '')""",
        "concat('</head><body><h1> H', doc_id, ' </h1>')",
        """if(doc_id % 7 < 5, concat('<a data-testid="authorName"> B', lang, ' </a>'), '')""",
        """if(doc_id % 6 < 4, concat('<time datetime="2025-12-1', doc_id % 10, '">x</time><time datetime="2020-01-01">y</time>'), '')""",
        "concat(if(doc_id % 8 < 4, '<section>', '<article>'), '<p>S', doc_id, '<p> second <b>bold</b> &amp; more</p>', if(doc_id % 8 < 4, '</section>', '</article>'))",
        """if(doc_id % 9 = 0, concat('<button data-testid="headerClapButton"> ', doc_id % 50, '.<b>5k</b> </button>'), '')""",
        """if(doc_id % 10 = 0, concat('<button aria-label="responses">', doc_id % 30, '</button>'), '')""",
        "'</body></html>'",
    )
    return d.selectExpr("concat('http://x/', doc_id) as url", "lang as topic", f"concat({', '.join(parts)}) as html")


@register(
    "extract_markup",
    f"""SELECT concat('http://x/', doc_id) AS article_url, lang AS topic,
  CASE WHEN doc_id % 2 = 0 THEN concat('T', doc_id) ELSE concat('H', doc_id) END AS title,
  CASE WHEN doc_id % 3 = 0 THEN concat('A', source) WHEN doc_id % 7 < 5 THEN concat('B', lang) ELSE '' END AS author_name,
  concat('S', doc_id, chr(10), chr(10), 'second bold & more') AS page_content, concat('S', doc_id) AS first_line,
  CASE WHEN doc_id % 4 = 0 THEN concat('2026-01-0', 1 + doc_id % 9, 'T00:00:00Z')
       WHEN doc_id % 6 < 4 THEN concat('2025-12-1', doc_id % 10) END AS published_date,
  CASE WHEN doc_id % 9 = 0 THEN concat(doc_id % 50, '.5k') END AS clap_count,
  CASE WHEN doc_id % 10 = 0 THEN CAST(doc_id % 30 AS varchar) END AS comments_count,
  CASE WHEN doc_id % 5 = 0 THEN concat('http://i/', doc_id, '.png') END AS hero_image_url,
  CAST(NULL AS varchar) AS author_avatar_url, timestamp '{STAMP}' AS ingested_at,
  sha256(concat('S', doc_id, chr(10), chr(10), 'second bold & more')) AS content_hash, TRUE AS content_gated,
  CAST(NULL AS varchar) AS error
FROM documents""",
)
def extract_markup(spark: SparkSession, sf: str) -> DataFrame:
    return extract_articles(_marked_up(spark, sf), F.lit(STAMP).cast("timestamp"))


_LANDED_SQL = f"""WITH e AS ({SQL["extract_markup"]}),
d AS (SELECT *, CAST(regexp_extract(article_url, '[0-9]+') AS bigint) AS doc_id FROM e)"""


@register(
    "land_markup",
    f"""{_LANDED_SQL}
SELECT * EXCLUDE (doc_id, error), CAST(doc_id AS varchar) AS slug, 'article' AS kind FROM d WHERE doc_id % 12 <> 0
UNION ALL SELECT article_url, topic, {', '.join(f'NULL AS {c}' for c in ARTICLE_COLUMNS[2:11])}, timestamp '{STAMP}' AS ingested_at,
  NULL AS content_hash, NULL AS content_gated, NULL AS slug, 'error' AS kind FROM d WHERE doc_id % 12 = 0""",
)
def land_markup(spark: SparkSession, sf: str) -> DataFrame:
    """Some pages landed, then all, chosen by a filter: every column of what was landed, once, and the pages without HTML."""
    root = Scratch(spark).path("lake")
    pos = F.regexp_extract("url", "[0-9]+", 0).cast("long")
    pages = _marked_up(spark, sf).withColumn("pos", pos).withColumn("html", F.when(F.col("pos") % 12 != 0, F.col("html")))
    pages = Scratch(spark).write(pages)
    pipeline.land_pages(spark, pages.where("pos % 3 = 0"), root, DAY, STAMP_TIME)
    for _ in range(2):
        pipeline.land_pages(spark, pages, root, DAY, STAMP_TIME, few=0)
    landed = T.StructType([*BRONZE_ARTICLE.fields, T.StructField("slug", T.StringType())])
    articles_back = spark.read.schema(landed).json(f"{root}/{layout.ARTICLES}").select(*landed.fieldNames(), F.lit("article").alias("kind"))
    errors = spark.read.schema(ERROR_RECORD).json(f"{root}/{layout.ERRORS}")
    values = {"article_url": F.col("url"), "topic": F.col("topic"), "ingested_at": F.col("failed_at"), "kind": F.lit("error")}
    failed = errors.select(*[values.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name) for f in articles_back.schema])
    return articles_back.unionByName(failed)


@register("extract_stamp", "SELECT count(*) AS pages, count(*) AS stamped, CAST(1 AS bigint) AS stamps FROM documents")
def extract_stamp(spark: SparkSession, sf: str) -> DataFrame:
    """Without a stamp all articles of a job get the time of the job."""
    found = extract_articles(_marked_up(spark, sf))
    recent = F.col("ingested_at") >= F.current_timestamp() - F.expr("interval 1 day")
    return found.agg(F.count("*").alias("pages"), F.sum(recent.cast("long")).alias("stamped"), F.countDistinct("ingested_at").alias("stamps"))


@register(
    "chunk_uuid",
    f"WITH {SILVER_SQL},{CHUNKS_SQL} SELECT count(*) AS chunks, count(*) AS ids, count(*) AS shaped FROM chunks",
)
def chunk_uuid(spark: SparkSession, sf: str) -> DataFrame:
    """Random ids: as many as chunks, each of the right shape."""
    chunks = article_chunks(silver(spark, sf), chunk_id="uuid")
    shaped = F.col("chunk_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return chunks.agg(F.count("*").alias("chunks"), F.countDistinct("chunk_id").alias("ids"), F.sum(shaped.cast("long")).alias("shaped"))


def length_model() -> Callable[[list[str]], list[list[float]]]:
    """A model of the user's own: the length of a text and how often it holds an ``e``; some texts it refuses."""

    def vector(text: str) -> list[float]:
        if len(text) % 17 == 0:
            raise ValueError("refused")
        return [float(len(text)), float(text.count("e"))]

    return lambda texts: [vector(t) for t in texts]


@register(
    "embed_errors",
    """SELECT doc_id, CASE WHEN length(text) % 17 <> 0 THEN length(text) END AS letters,
  CASE WHEN length(text) % 17 <> 0 THEN length(text) - length(replace(text, 'e', '')) END AS es,
  CASE WHEN length(text) % 17 = 0 THEN 'ValueError: refused' END AS error FROM documents""",
)
def embed_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Each text has the vector of its model or the error, also when it shares a batch with a refused one."""
    documents = spread_small_scan(table(spark, sf, "documents").select("doc_id", "text"))
    found = embed(documents, FunctionEmbedder(length_model), "text", error_col="error")
    return found.select("doc_id", F.col("embedding")[0].cast("long").alias("letters"), F.col("embedding")[1].cast("long").alias("es"), "error")
