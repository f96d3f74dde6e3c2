"""One query per operator, with production parameters, over the whole table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import audit, bpe, decontaminate, importance, jaccard, langid, mixing, negatives, pii, rabitq, secrets, sharding, urls
from lectern.llm.words import small_batches

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

SHARDS = 8
HOST_RULES = (
    urls.HostRule("block", "net", "/"),
    urls.HostRule("allow", "example.net", "/en/"),
    urls.HostRule("block", "example.com", "/de/"),
    urls.HostRule("allow", "org", "/fr/"),
)
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf}/{name}.parquet")


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Where the public rank file lies. Every executor has the package of public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf, "documents"))


@query
def op3_langid(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(table(spark, sf, "documents"))


@query
def op4_secrets(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf, "documents"))


@query
def op5_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return urls.judge(table(spark, sf, "pages"), HOST_RULES)


SQL["op5_url_filter"] = urls.judge_sql(HOST_RULES)


@query
def op6_importance(spark: SparkSession, sf: str) -> DataFrame:
    return importance.resample(table(spark, sf, "documents"), table(spark, sf, "labels").where("quality = 1"))


@query
def op7_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return rabitq.near_duplicates(table(spark, sf, "embeddings"))


SQL["op7_embedding_dedup"] = rabitq.near_duplicates_sql()


@query
def op8_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf, "documents"), SHARDS)


@query
def op9_ngram_jaccard(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, sf, "documents"))


SQL["op9_ngram_jaccard"] = jaccard.near_duplicates_sql()


@query
def op10_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(table(spark, sf, "documents"), vocabulary_path())


@query
def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


SQL["op11_filter_audit"] = audit.audit_sql()


@query
def op12_mixing(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(table(spark, sf, "documents"))


@query
def op13_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, label)


SQL["op13_hard_negatives"] = negatives.mine_sql()
