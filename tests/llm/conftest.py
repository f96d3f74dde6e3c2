from __future__ import annotations

import pytest

#: Rows that every operator must bear: nulls, empty and blank texts, repeated rows, ties, a long text.
ODD = [
    (1, "the cat sat on the mat and then it ran", "en", "a"),
    (1, "the cat sat on the mat and then it ran", "en", "a"),
    (2, "The cat sat on the mat and then it ran", "en", None),
    (3, None, "en", "a"),
    (4, "", None, "b"),
    (5, "  \n\t ", "de", "b"),
    (None, "und der hund lief über die straße nach hause", "de", "c"),
    (6, "漢字 😀 word's 'll don't " * 5, None, "c"),
    (7, "one two", "en", "c"),
    (7, "three four", "en", "c"),
    (8, "long words here " * 20000, "en", "d"),
    (9, "!!! ??? 123", "en", "d"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows, with columns whose names operators use for their own."""
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(ODD, schema).repartition(3)
    return docs.selectExpr("*", "length(text) n_chars", "0.5D score", "'x' lang_pred", "1 shard", "2 slot", "3L key", "4 n", "5L mark", "'y' token", "6 rank", "7 cell")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
