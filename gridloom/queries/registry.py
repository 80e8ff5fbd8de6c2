"""Registered queries and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from gridloom.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(run)
        def with_package(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return run(spark, sf_dir)

        QUERIES[name] = with_package
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def load() -> tuple[dict[str, Query], dict[str, str]]:
    """All queries; importing the modules registers them."""
    from gridloom.queries import columns, decoders, fixed, flat, links, sheets, sniffing, structure, tables  # noqa: F401

    return QUERIES, SQL
