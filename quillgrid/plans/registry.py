"""The register of queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
#: The moment as of which the queries run; never the clock, so that results repeat.
NOW = "2026-07-01 00:00:00"
NOW_MICROS = 1782864000000000


def query(sql: str | None = None):
    """Register a query under its name, with the SQL that gives the same rows where SQL can."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add
