import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from lectern.functions import derive


def one(spark, value, make):
    return spark.createDataFrame([(value,)], "v string").select(make("v").alias("r")).first()["r"]


@pytest.mark.parametrize(
    "url, slug",
    [
        ("https://m.com/@a/x-1b?source=rss", "x-1b"),
        ("https://m.com/a/", hashlib.md5(b"https://m.com/a/").hexdigest()),
        ("plain", "plain"),
        ("https://m.com/a?x=/b/c", "a"),
    ],
)
def test_slug(spark, url, slug):
    assert one(spark, url, derive.url_slug) == slug


def test_slug_of_legacy_falls_back_to_a_given_value(spark):
    assert one(spark, "https://m.com/a/", lambda c: derive.url_slug(c, F.lit("hash"))) == "hash"


@pytest.mark.parametrize(
    "raw, day",
    [
        ("2026-04-14T10:00:00Z", dt.date(2026, 4, 14)),
        ("2026-1-1", dt.date(2026, 1, 1)),
        ("", None),
        (None, None),
        ("01/01/2026", None),
        ("2026-02-30", None),
    ],
)
def test_date(spark, raw, day):
    assert one(spark, raw, derive.parse_date) == day


def test_date_text_is_unchecked(spark):
    assert one(spark, "01/01/2026T9", derive.date_text) == "01/01/2026"


@pytest.mark.parametrize("text, gated", [("a" * 199, True), ("a" * 200, False), (None, True), ("é" * 200, False)])
def test_gate(spark, text, gated):
    assert one(spark, text, derive.gate_flag) is gated


def test_gate_trimmed(spark):
    assert one(spark, " " * 300, lambda c: derive.gate_flag(c, trimmed=True)) is True


def test_hash(spark):
    assert one(spark, "é", derive.content_hash) == hashlib.sha256("é".encode()).hexdigest()
    assert one(spark, "é", lambda c: derive.content_hash(c, "md5")) == hashlib.md5("é".encode()).hexdigest()
    with pytest.raises(ValueError):
        derive.content_hash("v", "crc")


def test_chunk_key_without_hash_takes_the_fallback(spark):
    df = spark.createDataFrame([("h", 0), ("", 1), (None, 2)], "content_hash string, i int")
    got = [r[0] for r in df.select(derive.chunk_key("i", F.lit("stem"))).collect()]
    assert got == ["h_chunk_0", "stem_chunk_1", "stem_chunk_2"]


def test_prepared_document_defaults(spark):
    df = spark.createDataFrame(
        [(None, None, None, None, None)],
        "title string, author_name string, published_date date, article_url string, page_content string",
    )
    assert df.select(derive.prepared_document("2026-01-05")).first()[0] == (
        "Title: Untitled\nAuthor: Unknown\nDate: 2026-01-05\nURL: \n\n"
    )
