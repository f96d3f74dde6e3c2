"""Registered queries: each operator on the driver tables, beside the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = function
        if sql:
            SQL[name] = sql
        return function

    return add


def load_all() -> None:
    from lectern.registry import derived, files, jobs, pages, rejected, retrieval, upserts  # noqa: F401
