import pytest
from pyspark.sql import functions as F

from lectern.functions.embedding import FunctionEmbedder, HashingEmbedder, embed
from lectern.operators import answer
from lectern.registry.retrieval import first_context

E8 = HashingEmbedder(8)


def questions(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "question_id int, query string")


def chunks(spark, *rows):
    df = spark.createDataFrame(list(rows), "chunk_id string, article_url string, title string, chunk_text string")
    return embed(df, E8, "chunk_text")


def test_blank_questions_are_skipped(spark):
    asked = questions(spark, "", "  ", "\t\n", "　\x1c", None, "a", " b ")
    assert [r["query"] for r in answer.drop_blank(asked).collect()] == ["a", " b "]


def test_retrieval_and_prompts(spark):
    gold = chunks(spark, ("c1", "u1", "T1", "red fox"), ("c2", "u1", None, "red cat"), ("c3", "u3", "", "blue sea sky"))
    asked = questions(spark, "red fox", "blue sea sky")
    hits = answer.retrieve_context(asked, gold, E8, k=2, payload=("chunk_text", "title"))
    got = {(r["question_id"], r["rank"]): r["chunk_id"] for r in hits.collect()}
    assert got[0, 1] == "c1" and got[1, 1] == "c3" and len(got) == 4
    first = hits.where("rank = 1 or question_id = 0")
    prompts = {r["question_id"]: r for r in answer.context_prompt(asked, first).collect()}
    assert prompts[1]["prompt"] == (
        "Using this context (from the indexed articles):\nSource: u3\nblue sea sky\n\nQuestion: blue sea sky"
    )
    assert prompts[0]["context"].startswith("Source: u1\nred fox\n\nSource: ")
    assert prompts[1]["sources"] == ["u3"]
    strict = {r["question_id"]: r for r in answer.strict_prompt(asked, first).collect()}
    assert strict[1]["context"] == "\n--- Source 1: Unknown (u3) ---\nblue sea sky\n"
    assert strict[1]["prompt"].endswith("Question:\nblue sea sky\n")


def test_questions_without_hits(spark):
    gold = chunks(spark).where("false")
    asked = questions(spark, "red {query} fox")
    hits = answer.retrieve_context(asked, gold, E8, payload=("chunk_text", "title"))
    row = answer.context_prompt(asked, hits, corpus="our").first()
    assert row["prompt"] == "Using this context (from our articles):\nNo context found.\n\nQuestion: red {query} fox"
    assert row["sources"] == ["web_search"]
    assert answer.strict_prompt(asked, hits).count() == 0 and answer.answer_sources(hits).count() == 0


def test_answers(spark):
    gold = chunks(spark, ("c1", "u1", "T", "red fox"), ("c2", "u2", "T", "blue sea"))
    got = answer.answer_questions(questions(spark, "red fox", " "), gold, E8, lambda: first_context, k=1).collect()
    assert [(r["question_id"], r["answer"], r["sources"]) for r in got] == [(0, "u1", ["u1"])]


def test_model_failure_fails_the_job(spark):
    def broken(texts):
        raise RuntimeError("model is down")

    prompts = spark.createDataFrame([("p",)], "prompt string")
    with pytest.raises(Exception, match="model is down"):
        answer.generate(prompts, lambda: broken).collect()


def test_hashing_embedder(spark):
    df = spark.createDataFrame([("Red red fox",), ("red RED FOX",), ("",), (None,)], "t string")
    a, b, empty, null = [r["embedding"] for r in embed(df, E8, "t").collect()]
    assert a == b and len(a) == 8 and abs(sum(x * x for x in a) - 1) < 1e-12
    assert empty == [0.0] * 8 and null is None


def test_function_embedder_isolates_bad_texts(spark):
    def factory():
        def model(texts):
            if "bad" in texts:
                raise ValueError("no vector for bad")
            return [[float(len(t)), 1.0] for t in texts]

        return model

    df = spark.createDataFrame([(1, "a"), (2, "bad"), (3, None), (4, "cc")], "i int, t string").coalesce(1)
    rows = embed(df, FunctionEmbedder(factory, batch=3), "t", error_col="error").orderBy("i").collect()
    assert [r["embedding"] for r in rows] == [[1.0, 1.0], None, None, [2.0, 1.0]]
    assert rows[1]["error"] == "ValueError: no vector for bad" and rows[0]["error"] is None and rows[3]["t"] == "cc"


def test_failed_embeddings_are_not_searched(spark):
    df = spark.createDataFrame([("c1", "u", "x"), ("c2", "u", "y")], "chunk_id string, article_url string, chunk_text string")
    gold = embed(df, E8, "chunk_text").withColumn("embedding", F.when(F.col("chunk_id") == "c1", F.col("embedding")))
    hits = answer.retrieve_context(questions(spark, "y"), gold, E8)
    assert [r["chunk_id"] for r in hits.collect()] == ["c1"]
