"""Training text from documents: language, near duplicates, benchmark passages, secrets, tokens.

Each stage takes what the one before kept and is written as Parquet before the next reads it. All but the last
return the columns of documents. Null and empty texts have no language and go in the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, decontaminate, jaccard, langid, queries, secrets
from lectern.llm.words import small_batches
from lectern.scratch import Scratch

#: Score under which a document counts as being in no language known.
LEAST_SCORE = 0.4


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; without any labelled document, those with a letter."""
    small_batches(spark)
    network = langid.learn(docs.where(~F.coalesce(langid.held_out(F.col("doc_id")), F.lit(False))).select("doc_id", "text", "lang"))
    if network is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    others = [c for c in docs.columns if c != "text"]
    whole = docs.select(F.struct(*others).alias("others"), "text")  # columns of any name pass through
    told = langid.predict(whole, network).where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SCORE))
    return told.select("others.*", "text").select(*docs.columns)


def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_contaminated(docs, queries.table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets become a sign; n_chars follows the text."""
    small_batches(spark)
    out = secrets.mask_secrets(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text."""
    small_batches(spark)
    coded = bpe.encode(docs.select("doc_id", "lang", "source", "text"), queries.vocabulary_path(), exact="round_trip")
    return coded.select("doc_id", "lang", "source", F.size("token_ids").cast("long").alias("n_tokens"), "round_trip", "token_ids")


STAGES = [
    ("language_id", keep_known_language),
    ("ngram_jaccard", keep_one_of_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", mask_secrets),
    ("bpe", encode),
]

#: The trained stages cannot be written in SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
