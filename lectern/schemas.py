"""Table schemas of the three layers: bronze JSON, silver articles, gold chunks."""

from __future__ import annotations

from pyspark.sql import types as T

_S = T.StringType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The article columns in load order.
BRONZE_ARTICLE = _struct(
    ("article_url", _S),
    ("topic", _S),
    ("title", _S),
    ("author_name", _S),
    ("page_content", _S),
    ("first_line", _S),
    ("published_date", _S),
    ("clap_count", _S),
    ("comments_count", _S),
    ("hero_image_url", _S),
    ("author_avatar_url", _S),
    ("ingested_at", T.TimestampType()),
    ("content_hash", _S),
    ("content_gated", T.BooleanType()),
)
ARTICLE_COLUMNS = BRONZE_ARTICLE.fieldNames()

# Silver is the same row with the date parsed.
SILVER_ARTICLE = T.StructType(
    [T.StructField(f.name, T.DateType() if f.name == "published_date" else f.dataType, True) for f in BRONZE_ARTICLE]
)

GOLD_CHUNK = _struct(
    ("article_url", _S),
    ("chunk_id", _S),
    ("chunk_text", _S),
    ("embedding", T.ArrayType(T.DoubleType(), False)),
    ("ingested_at", T.TimestampType()),
)
GOLD_COLUMNS = GOLD_CHUNK.fieldNames()

CHUNK_METADATA = _struct(("source", _S), ("title", _S), ("author", _S))

CHUNK_COLLECTION = _struct(
    ("chunk_id", _S), ("document", _S), ("metadata", CHUNK_METADATA), ("embedding", T.ArrayType(T.DoubleType(), False))
)

URL_LIST = _struct(("topic", _S), ("timestamp", _S), ("urls", T.ArrayType(_S)))

ERROR_RECORD = _struct(("url", _S), ("topic", _S), ("error", _S), ("failed_at", T.TimestampType()))

# What a matched row takes from the source in each upsert.
UPDATE_PARTIAL = (
    "topic",
    "title",
    "page_content",
    "published_date",
    "clap_count",
    "ingested_at",
    "content_hash",
)
UPDATE_ALL = tuple(c for c in ARTICLE_COLUMNS if c != "article_url")

# Limits and defaults.
GATE_CHARS = 200
WHITESPACE_CHUNK_CHARS = 800
FIXED_CHUNK_CHARS = 3000
WINDOW_TOKENS = 1024
WINDOW_OVERLAP = 128
MANIFEST_URLS = 2500
MAX_BAD_RECORDS = 1000
TOP_K = 3
REPORT_ROWS = 5
