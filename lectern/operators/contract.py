"""Data contract: which article rows break which rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.schemas import GATE_CHARS, REPORT_ROWS

# Rule names.
TOO_SHORT = "Content too short"
NO_TITLE = "Missing title"
BAD_URL = "Invalid URL"

# Fields a record must have, in the order they are checked.
REQUIRED = ("article_url", "title", "page_content", "published_date")


# Messages of the strict contract, around the value they name.
MISSING = "Missing required field: "
SHORT = ("Article content too short (", " chars). Likely gated or failed scrape.")
STRICT_URL = "Invalid article URL: "
STRICT_DATE = ("Invalid date format: ", ". Expected YYYY-MM-DD.")


class ContractError(ValueError):
    """Raised when violating rows are not allowed."""


def broken_rules() -> Column:
    """Array of the bulk rules a row breaks. Null content and null URL break none."""
    return F.array_compact(
        F.array(
            F.when(F.char_length("page_content") < GATE_CHARS, TOO_SHORT),
            F.when(F.col("title").isNull() | (F.col("title") == ""), NO_TITLE),
            F.when(~F.col("article_url").like("http%"), BAD_URL),
        )
    )


def violations(df: DataFrame) -> DataFrame:
    """One row per broken rule, found in a single pass over the articles."""
    return df.select("article_url", F.explode(broken_rules()).alias("violation"))


def strict_violation() -> Column:
    """First failed check of the strict record contract as a message; null for a valid record."""
    missing = [
        (F.coalesce(F.col(f), F.lit("")) == "", F.lit(MISSING + f)) for f in REQUIRED
    ]
    length = F.char_length("page_content")
    date = F.col("published_date")
    checks = missing + [
        (
            length < GATE_CHARS,
            F.concat(F.lit(SHORT[0]), length.cast("string"), F.lit(SHORT[1])),
        ),
        (~F.col("article_url").startswith("http"), F.concat(F.lit(STRICT_URL), "article_url")),
        (
            F.try_to_date(date, "yyyy-M-d").isNull(),
            F.concat(F.lit(STRICT_DATE[0]), date, F.lit(STRICT_DATE[1])),
        ),
    ]
    first = F.when(*checks[0])
    for condition, message in checks[1:]:
        first = first.when(condition, message)
    return first


def validate_records(df: DataFrame) -> DataFrame:
    """``df`` with a ``violation`` column from the strict contract."""
    return df.withColumn("violation", strict_violation())


def require_valid(df: DataFrame) -> DataFrame:
    """The same rows; the job fails with the message of a violating row."""
    return df.where(F.when(strict_violation().isNotNull(), F.raise_error(strict_violation()).isNull()).otherwise(True))


def report(found: DataFrame) -> DataFrame:
    """Rows per broken rule."""
    return found.groupBy("violation").agg(F.count("*").alias("rows"))


def sample(found: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The first few violations to show, in a fixed order."""
    return found.orderBy("article_url", "violation").limit(rows)


def apply_policy(df: DataFrame, on_violation: str = "warn") -> tuple[DataFrame, DataFrame]:
    """(rows to merge, rows held back).

    "warn" holds nothing back, "quarantine" holds back every row that breaks a bulk rule, "fail"
    raises if there is one.
    """
    bad = F.size(broken_rules()) > 0
    if on_violation == "warn":
        return df, df.where(F.lit(False))
    if on_violation == "quarantine":
        return df.where(~bad), df.where(bad)
    if on_violation == "fail":
        if not df.where(bad).isEmpty():
            raise ContractError("rows violate the data contract")
        return df, df.where(F.lit(False))
    raise ValueError(f"unknown policy: {on_violation}")
