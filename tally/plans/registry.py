"""Named queries over the test tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tally.plans.bindings import with_tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, tables: str = "") -> Callable[[Query], Query]:
    """Register a query; ``tables`` names the derived tables its SQL uses."""

    def add(fn: Query) -> Query:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = with_tables(tables, sql) if tables else sql.strip()
        return fn

    return add
