"""Questions to prompts, answers and sources, many at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.derive import or_default
from lectern.functions.embedding import Embedder, embed
from lectern.operators.search import nearest_neighbors
from lectern.schemas import TOP_K
from lectern.scratch import Scratch

# Characters trimmed from a typed question.
_BLANK = r"[\t-\r\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Format of the prompt, and what stands for no context.
NO_CONTEXT = "No context found."
WEB_SOURCE = "web_search"
PROMPT = "Using this context (from {corpus} articles):\n{context}\n\nQuestion: {question}"
#: A stricter wording of our own.
STRICT_PROMPT = (
    "Answer the question from the context alone. "
    "If the context does not hold the answer, reply that the provided articles do not say.\n\n"
    "Context:\n{context}\n\nQuestion:\n{question}\n"
)

HIT_BYTES_BROADCAST = 64 * 1024 * 1024


def not_blank(text: Column) -> Column:
    return text.rlike(rf"^{_BLANK}*[^{_BLANK[1:]}")


def drop_blank(questions: DataFrame, query: str = "query") -> DataFrame:
    """Questions with at least one visible character."""
    return questions.where(not_blank(F.col(query)))


def retrieve_context(
    questions: DataFrame,
    chunks: DataFrame,
    embedder: Embedder,
    k: int = TOP_K,
    metric: str = "euclidean",
    payload: tuple[str, ...] = ("chunk_text",),
    base_ids: tuple[str, ...] = ("chunk_id", "article_url"),
    on_error: str = "fail",
) -> DataFrame:
    """``question_id, rank, distance, chunk_id, article_url`` and ``payload`` of the ``k`` nearest chunks.

    ``questions`` has ``question_id, query``; ``chunks`` is the gold table. Only ids and vectors go
    through the search. Texts are looked up for the hits afterwards, in a second scan of the gold
    table that reads no vectors. A question that cannot be embedded fails the job, or with "skip" finds nothing.
    """
    # Staged: a search reads its questions more than once, and a search may take longer than a broadcast may wait.
    scratch = Scratch(questions.sparkSession)
    asked = scratch.write(embed(questions.select("question_id", "query"), embedder, "query", on_error=on_error))
    hits = scratch.write(nearest_neighbors(chunks, asked, k, base_ids=base_ids, metric=metric))
    texts = chunks.select(*base_ids, *payload)
    weight = sum((F.octet_length(F.col(c).cast("string")) for c in base_ids), F.lit(64))
    if (hits.agg(F.sum(weight)).first()[0] or 0) <= HIT_BYTES_BROADCAST:
        hits = F.broadcast(hits)
    return texts.join(hits, list(base_ids)).select(
        "question_id", "rank", "distance", *base_ids, *payload
    )


def _ordered(piece: Column, separator: str) -> Column:
    """Pieces of one question by rank. A question has at most k hits, so the list is short."""
    rows = F.array_sort(F.collect_list(F.struct(F.col("rank"), piece.alias("piece"))))
    return F.array_join(F.transform(rows, lambda r: r["piece"]), separator)


def _fill(template: str, values: dict[str, Column]) -> Column:
    """Template with ``{name}`` places to a concat of literals and columns."""
    parts: list[Column] = []
    rest = template
    while rest:
        head, brace, tail = rest.partition("{")
        if head:
            parts.append(F.lit(head))
        if not brace:
            break
        name, _, rest = tail.partition("}")
        parts.append(values[name])
    return F.concat(*parts)


def context_prompt(
    questions: DataFrame, hits: DataFrame, template: str = PROMPT, corpus: str = "the indexed"
) -> DataFrame:
    """``question_id, query, context, prompt, sources`` for every question, also those without a hit."""
    piece = F.concat(F.lit("Source: "), "article_url", F.lit("\n"), "chunk_text")
    grouped = hits.groupBy("question_id").agg(
        _ordered(piece, "\n\n").alias("__context"), F.collect_set("article_url").alias("__urls")
    )
    joined = questions.select("question_id", "query").join(grouped, "question_id", "left")
    context = F.coalesce("__context", F.lit(NO_CONTEXT))
    urls = F.coalesce("__urls", F.array().cast("array<string>"))
    sources = F.when(F.size(urls) > 0, F.array_sort(urls)).otherwise(F.array(F.lit(WEB_SOURCE)))
    return joined.select(
        "question_id", "query", context.alias("context"), sources.alias("sources")
    ).withColumn(
        "prompt",
        _fill(template, {"corpus": F.lit(corpus), "context": F.col("context"), "question": F.col("query")}),
    )


def strict_prompt(questions: DataFrame, hits: DataFrame, template: str = STRICT_PROMPT) -> DataFrame:
    """Prompt that names each numbered source. A question without hits gets no row.

    ``hits`` carries ``title`` beside the columns of :func:`retrieve_context`.
    """
    piece = F.concat(
        F.lit("\n--- Source "),
        F.col("rank").cast("string"),
        F.lit(": "),
        or_default("title", "Unknown"),
        F.lit(" ("),
        "article_url",
        F.lit(") ---\n"),
        "chunk_text",
        F.lit("\n"),
    )
    grouped = hits.groupBy("question_id").agg(
        _ordered(piece, "").alias("context"), F.array_sort(F.collect_set("article_url")).alias("sources")
    )
    joined = questions.select("question_id", "query").join(grouped, "question_id")
    return joined.withColumn("prompt", _fill(template, {"context": F.col("context"), "question": F.col("query")}))


def answer_sources(hits: DataFrame) -> DataFrame:
    """Distinct article URLs behind each question's hits."""
    return hits.groupBy("question_id").agg(F.array_sort(F.collect_set("article_url")).alias("sources"))


def generate(
    prompts: DataFrame,
    factory: Callable[[], Callable[[list[str]], list[str]]],
    prompt_col: str = "prompt",
    batch: int = 32,
) -> DataFrame:
    """Add ``answer`` from a user's text model; ``factory`` runs once per Python worker task.

    A failure of the model fails the job.
    """

    @F.pandas_udf("string")
    def answer_batches(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = factory()
        for series in batches:
            texts, out = series.tolist(), []
            for at in range(0, len(texts), batch):
                out.extend(model(texts[at : at + batch]))
            yield pd.Series(out, dtype="object")

    return prompts.withColumn("answer", answer_batches(F.col(prompt_col)))


def answer_questions(
    questions: DataFrame,
    chunks: DataFrame,
    embedder: Embedder,
    model: Callable[[], Callable[[list[str]], list[str]]],
    k: int = TOP_K,
) -> DataFrame:
    """``question_id, answer, sources`` for every non-blank question."""
    asked = drop_blank(questions)
    hits = retrieve_context(asked, chunks, embedder, k)
    return generate(context_prompt(asked, hits), model).select("question_id", "answer", "sources")
