"""Embedding, search, prompts and sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.embedding import HashingEmbedder, embed
from lectern.operators import answer, chunking
from lectern.operators.search import nearest_neighbors
from lectern.operators.sizing import spread_small_scan
from lectern.registry import register
from lectern.registry.views import HASH_DIM, HITS_SQL, questions, silver, table, vectors_sql


@register(
    "embed_hash",
    f"""WITH {vectors_sql("dv", "documents", "doc_id", "text")}
SELECT doc_id, CAST(i - 1 AS integer) AS dim, round(v[i], 6) AS weight
FROM (SELECT *, unnest(range(1, {HASH_DIM + 1})) AS i FROM dv) WHERE v[i] > 0""",
)
def embed_hash(spark: SparkSession, sf: str) -> DataFrame:
    documents = spread_small_scan(table(spark, sf, "documents").select("doc_id", "text"))
    vectors = embed(documents, HashingEmbedder(HASH_DIM), "text")
    rounded = F.transform("embedding", lambda w: F.round(w, 6))
    return vectors.select("doc_id", F.posexplode(rounded).alias("dim", "weight")).where("weight > 0")


def _neighbors(spark: SparkSession, sf: str, metric: str) -> DataFrame:
    vectors = spread_small_scan(table(spark, sf, "embeddings").select("vec_id", "embedding"))
    asked = vectors.withColumnRenamed("vec_id", "query_id")
    return nearest_neighbors(vectors, asked, 10, base_ids=("vec_id",), query_id="query_id", metric=metric)


def _neighbors_sql(distance: str) -> str:
    return f"""WITH e AS (SELECT vec_id, CAST(embedding AS double[]) AS v FROM embeddings),
d AS (SELECT q.vec_id AS query_id, b.vec_id, round({distance}, 9) AS distance FROM e q, e b)
SELECT query_id, CAST(rank AS integer) AS rank, distance, vec_id
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank FROM d) WHERE rank <= 10"""


@register("vector_topk", _neighbors_sql("list_distance(q.v, b.v)"))
def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbors(spark, sf, "euclidean")


@register("vector_topk_cosine", _neighbors_sql("list_cosine_distance(q.v, b.v)"))
def vector_topk_cosine(spark: SparkSession, sf: str) -> DataFrame:
    return _neighbors(spark, sf, "cosine")


def _gold(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of all open articles with their vectors, computed on the way."""
    rows = silver(spark, sf).select("article_url", "title", "page_content", "content_hash", "content_gated")
    chunks = chunking.article_chunks(rows).select("chunk_id", "article_url", "title", "chunk_text")
    return embed(chunks, HashingEmbedder(HASH_DIM), "chunk_text")


def _hits(spark: SparkSession, sf: str) -> DataFrame:
    return answer.retrieve_context(
        questions(spark, sf), _gold(spark, sf), HashingEmbedder(HASH_DIM), payload=("chunk_text", "title")
    )


@register(
    "retrieve_context",
    f"WITH {HITS_SQL} SELECT question_id, CAST(rank AS integer) AS rank, distance, chunk_id, article_url, chunk_text"
    " FROM hits",
)
def retrieve_context(spark: SparkSession, sf: str) -> DataFrame:
    return _hits(spark, sf).drop("title")


@register(
    "prompt_context",
    f"""WITH {HITS_SQL},
ctx AS (SELECT question_id, string_agg(concat('Source: ', article_url, chr(10), chunk_text), chr(10) || chr(10)
  ORDER BY rank) AS c FROM hits GROUP BY question_id)
SELECT question_id, concat('Using this context (from the indexed articles):', chr(10),
  coalesce(c, 'No context found.'), chr(10), chr(10), 'Question: ', query) AS prompt
FROM asked LEFT JOIN ctx USING (question_id)""",
)
def prompt_context(spark: SparkSession, sf: str) -> DataFrame:
    return answer.context_prompt(questions(spark, sf), _hits(spark, sf)).select("question_id", "prompt")


@register(
    "prompt_strict",
    f"""WITH {HITS_SQL},
ctx AS (SELECT question_id, string_agg(concat(chr(10), '--- Source ', rank, ': ',
  coalesce(nullif(title, ''), 'Unknown'), ' (', article_url, ') ---', chr(10), chunk_text, chr(10)), ''
  ORDER BY rank) AS context FROM hits GROUP BY question_id)
SELECT question_id, concat('Sources:', chr(10), context, chr(10), 'Asked: ', query) AS prompt
FROM asked JOIN ctx USING (question_id)""",
)
def prompt_strict(spark: SparkSession, sf: str) -> DataFrame:
    template = "Sources:\n{context}\nAsked: {question}"
    return answer.strict_prompt(questions(spark, sf), _hits(spark, sf), template).select("question_id", "prompt")


@register(
    "answer_sources",
    f"""WITH {HITS_SQL}
SELECT question_id, string_agg(DISTINCT article_url, '|' ORDER BY article_url) AS sources
FROM hits GROUP BY question_id""",
)
def answer_sources(spark: SparkSession, sf: str) -> DataFrame:
    found = answer.answer_sources(_hits(spark, sf))
    return found.select("question_id", F.array_join("sources", "|").alias("sources"))


def first_context(prompts: list[str]) -> list[str]:
    """Stand-in for a text model: the first source named in the prompt."""
    return [p.split("Source: ", 1)[1].split("\n", 1)[0] if "Source: " in p else "" for p in prompts]


@register(
    "answers_stub",
    f"""WITH {HITS_SQL}
SELECT question_id, max(article_url) FILTER (WHERE rank = 1) AS answer,
  string_agg(DISTINCT article_url, '|' ORDER BY article_url) AS sources
FROM hits GROUP BY question_id""",
)
def answers_stub(spark: SparkSession, sf: str) -> DataFrame:
    found = answer.answer_questions(
        questions(spark, sf), _gold(spark, sf), HashingEmbedder(HASH_DIM), lambda: first_context
    )
    return found.select("question_id", "answer", F.array_join("sources", "|").alias("sources"))


_ASKED = "CASE WHEN turn % 7 = 3 THEN concat(chr(9), ' ', chr(10)) WHEN turn % 7 = 5 THEN '' ELSE text END"


@register(
    "blank_questions",
    f"""SELECT conv_id, turn, query FROM (SELECT conv_id, turn, {_ASKED} AS query FROM conversations)
WHERE trim(query, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) <> ''""",
)
def blank_questions(spark: SparkSession, sf: str) -> DataFrame:
    asked = table(spark, sf, "conversations").selectExpr("conv_id", "turn", f"{_ASKED} as query")
    return answer.drop_blank(asked)
