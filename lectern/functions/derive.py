"""Derived article columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.schemas import GATE_CHARS, SILVER_ARTICLE


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def content_hash(content: Column | str, algorithm: str = "sha256") -> Column:
    """Hex digest of the content; ``md5`` is the older form."""
    if algorithm == "sha256":
        return F.sha2(_col(content), 256)
    if algorithm == "md5":
        return F.md5(_col(content))
    raise ValueError(f"unknown hash algorithm: {algorithm}")


def gate_flag(content: Column | str, trimmed: bool = False, limit: int = GATE_CHARS) -> Column:
    """True for pages whose text is too short to be the whole article; null text counts as length 0."""
    text = F.trim(_col(content)) if trimmed else _col(content)
    return F.coalesce(F.char_length(text), F.lit(0)) < limit


def url_slug(url: Column | str, empty: Column | None = None) -> Column:
    """Last path segment without the query string; ``empty`` (default: MD5 of the URL) replaces ''."""
    path = F.split_part(_col(url), F.lit("?"), F.lit(1))
    last = F.nullif(F.substring_index(path, "/", -1), F.lit(""))
    return F.coalesce(last, F.md5(_col(url)) if empty is None else empty)


def date_text(raw: Column | str) -> Column:
    """Text before the first 'T', unchecked."""
    return F.split_part(_col(raw), F.lit("T"), F.lit(1))


def parse_date(raw: Column | str) -> Column:
    """Day of an ISO date or timestamp text; anything unparsable is null."""
    return F.try_to_date(date_text(raw), "yyyy-M-d")


def or_default(value: Column | str, default: str) -> Column:
    """``value``, with null and '' replaced."""
    return F.coalesce(F.nullif(_col(value), F.lit("")), F.lit(default))


def prepared_document(run_date: str | Column) -> Column:
    """One labelled text per article, for export to an outside index."""
    day = F.lit(run_date) if isinstance(run_date, str) else run_date
    return F.concat(
        F.lit("Title: "),
        F.coalesce("title", F.lit("Untitled")),
        F.lit("\nAuthor: "),
        F.coalesce("author_name", F.lit("Unknown")),
        F.lit("\nDate: "),
        F.coalesce(F.col("published_date").cast("string"), day),
        F.lit("\nURL: "),
        F.coalesce("article_url", F.lit("")),
        F.lit("\n\n"),
        F.coalesce("page_content", F.lit("")),
    )


def chunk_metadata() -> Column:
    """Struct of source, title and author as kept beside each local chunk."""
    return F.struct(
        F.col("article_url").alias("source"),
        or_default("title", "Unknown").alias("title"),
        or_default("author_name", "Unknown").alias("author"),
    )


def chunk_key(position: Column | str, fallback: Column | None = None) -> Column:
    """``{content hash}_chunk_{i}``; ``fallback`` names the article when it has no hash."""
    owner = F.nullif(F.col("content_hash"), F.lit(""))
    if fallback is not None:
        owner = F.coalesce(owner, fallback)
    return F.concat(owner, F.lit("_chunk_"), _col(position).cast("string"))


def silver_columns() -> list[Column]:
    """The article columns in order, date parsed: bronze row to silver row."""
    return [
        parse_date(f.name).alias(f.name) if f.name == "published_date" else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in SILVER_ARTICLE
    ]
