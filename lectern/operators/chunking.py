"""Article rows to chunk rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import derive, text
from lectern.schemas import FIXED_CHUNK_CHARS, WHITESPACE_CHUNK_CHARS, WINDOW_OVERLAP, WINDOW_TOKENS


def explode_chunks(df: DataFrame, pieces: Column, position: str = "chunk_index") -> DataFrame:
    """One row per element with its position from 0; rows without pieces drop out."""
    return df.select("*", F.posexplode(pieces).alias(position, "chunk_text"))


def chunk_whitespace(df: DataFrame, size: int = WHITESPACE_CHUNK_CHARS, content: str = "page_content") -> DataFrame:
    return explode_chunks(df, text.whitespace_chunks(content, size))


def chunk_fixed(df: DataFrame, size: int = FIXED_CHUNK_CHARS, content: str = "page_content") -> DataFrame:
    return explode_chunks(df, text.fixed_slices(content, size))


def chunk_tokens(
    df: DataFrame, size: int = WINDOW_TOKENS, overlap: int = WINDOW_OVERLAP, content: str = "page_content"
) -> DataFrame:
    held = "__tokens"
    split = df.withColumn(held, text.tokens(content))
    return explode_chunks(split, text.token_windows(held, size, overlap)).drop(held)


CHUNKERS = {"whitespace": chunk_whitespace, "fixed": chunk_fixed, "tokens": chunk_tokens}


def article_chunks(
    articles: DataFrame,
    chunker: str = "whitespace",
    chunk_id: str = "derived",
    exclude_gated: bool = True,
    keep_unknown_gate: bool = False,
    id_fallback: Column | None = None,
    **options: int,
) -> DataFrame:
    """Articles to ``article_url, chunk_id, chunk_text`` (plus the article's other columns).

    Gated articles stay out unless ``exclude_gated`` is off; ``keep_unknown_gate`` decides for a null
    flag. ``chunk_id`` is "derived" (content hash and position, the same on every run) or "uuid".
    """
    kept = articles
    if exclude_gated:
        kept = kept.where(open_articles(keep_unknown_gate))
    rows = CHUNKERS[chunker](kept, **options)
    if chunk_id == "uuid":
        return rows.withColumn("chunk_id", F.uuid())
    if chunk_id != "derived":
        raise ValueError(f"unknown chunk id rule: {chunk_id}")
    fallback = F.md5("article_url") if id_fallback is None else id_fallback
    return rows.withColumn("chunk_id", derive.chunk_key("chunk_index", fallback))


def open_articles(keep_unknown: bool = False) -> Column:
    """Rows that may be indexed: gate flag false; a null flag only with ``keep_unknown``."""
    flag = F.col("content_gated")
    return ~F.coalesce(flag, F.lit(False)) if keep_unknown else ~flag
