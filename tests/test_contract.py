import pytest
from pyspark.errors import PySparkException

from lectern.operators import contract

SCHEMA = "article_url string, title string, page_content string, published_date string"
URL = "https://site.example/@test/my-article"


def record(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.mark.parametrize(
    "row, message",
    [
        ((URL, "Test Title", "A" * 250, "2026-01-01"), None),
        ((URL, "Test Title", None, "2026-01-01"), "Missing required field: page_content"),
        (
            (URL, "Test Title", "Too short", "2026-01-01"),
            "Article content too short (9 chars). Likely gated or failed scrape.",
        ),
        (("invalid-url", "Test Title", "A" * 250, "2026-01-01"), "Invalid article URL: invalid-url"),
        ((URL, "Test Title", "A" * 250, "01/01/2026"), "Invalid date format: 01/01/2026. Expected YYYY-MM-DD."),
        ((URL, "Test Title", "A" * 250, "2026-01-01T00:00:00Z"),
         "Invalid date format: 2026-01-01T00:00:00Z. Expected YYYY-MM-DD."),
        ((None, None, None, None), "Missing required field: article_url"),
        (("invalid-url", "", "short", "x"), "Missing required field: title"),
    ],
)
def test_strict_contract(spark, row, message):
    df = record(spark, row)
    assert contract.validate_records(df).first()["violation"] == message
    if message is None:
        assert contract.require_valid(df).count() == 1
    else:
        with pytest.raises(PySparkException, match=message[:20]):
            contract.require_valid(df).collect()


def test_bulk_rules_ignore_nulls_and_report_each_rule(spark):
    df = record(spark, (None, "t", None, None), ("ftp://x", "", "short", None), (URL, None, "A" * 200, None))
    got = sorted(tuple(r) for r in contract.violations(df).collect())
    assert got == [
        ("ftp://x", "Content too short"),
        ("ftp://x", "Invalid URL"),
        ("ftp://x", "Missing title"),
        (URL, "Missing title"),
    ]
    assert {tuple(r) for r in contract.report(contract.violations(df)).collect()} == {
        ("Content too short", 1), ("Invalid URL", 1), ("Missing title", 2)
    }


def test_policies(spark):
    df = record(spark, (URL, "t", "A" * 300, None), (URL, None, "A" * 300, None))
    kept, held = contract.apply_policy(df)
    assert (kept.count(), held.count()) == (2, 0)
    kept, held = contract.apply_policy(df, "quarantine")
    assert (kept.count(), held.count()) == (1, 1)
    with pytest.raises(contract.ContractError):
        contract.apply_policy(df, "fail")
    with pytest.raises(ValueError):
        contract.apply_policy(df, "other")


def test_bulk_scan_reads_once(spark, folder):
    record(spark, (URL, "t", "A", None)).write.parquet(folder + "/t")
    plan = contract.violations(spark.read.parquet(folder + "/t"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
