import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.functions import text
from lectern.operators import chunking


def rows(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "i int, t string")


def chunks(spark, texts, size):
    found = rows(spark, texts).select("i", text.whitespace_chunks("t", size).alias("c")).collect()
    return [r["c"] for r in sorted(found, key=lambda r: r["i"])]


def plain_rule(t, size):
    return re.findall(rf"[^\n]{{1,{size}}}(?:[\t\n\f\r ]|\Z)", t)


@pytest.mark.parametrize(
    "given_text, expected",
    [
        ("ab cd\nef", ["ab ", "cd\n", "ef"]),
        ("ab\r\ncd", ["ab\r\n", "cd"]),
        ("ab\vcd", ["b\vcd"]),
        ("", []),
        ("\n\n", []),
        ("abcdefgh ij", ["efgh ", "ij"]),
        ("abcdefgh", ["efgh"]),
    ],
)
def test_whitespace_chunks(spark, given_text, expected):
    assert chunks(spark, [given_text], 4) == [expected]


def test_null_text_gives_no_chunk(spark):
    assert chunking.chunk_whitespace(rows(spark, [None]), content="t").count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="ab\n\r\t\v   \x85é😀", max_size=60), min_size=20, max_size=60), st.integers(1, 9))
def test_chunk_pattern_equals_the_plain_rule(spark, texts, size):
    assert chunks(spark, texts, size) == [plain_rule(t, size) for t in texts]


def test_long_unbroken_run_is_not_retried_per_character(spark):
    run = "x" * 3_000_000
    assert chunks(spark, ["ab " + run + " cd"], 800) == [["ab ", "x" * 800 + " ", "cd"]]


def test_fixed_slices(spark):
    got = rows(spark, ["abcdefg", "abc", "", None, "abcdef"]).select(text.fixed_slices("t", 3).alias("c")).collect()
    assert [r["c"] for r in got] == [["abc", "def", "g"], ["abc"], [], [], ["abc", "def"]]


@pytest.mark.parametrize("count", [0, 1, 2, 5, 6, 9, 10, 14])
def test_token_windows(spark, count):
    words = [f"w{i}" for i in range(count)]
    df = rows(spark, [" \n".join(words)]).select(text.token_windows(text.tokens("t"), 5, 1).alias("c"))
    expected, at = [], 0
    while at < count:
        expected.append(" ".join(words[at : at + 5]))
        if at + 5 >= count:
            break
        at += 4
    assert df.first()["c"] == expected


def test_window_overlap_must_be_smaller():
    with pytest.raises(ValueError):
        text.token_windows(F.col("x"), 5, 5)
