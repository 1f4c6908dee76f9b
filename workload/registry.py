"""Registered queries: a name, a Spark callable, and DuckDB SQL for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workload.inputs import with_inputs

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, **extra: str) -> Callable[[Query], Query]:
    """Register a query; ``extra`` holds more named inputs for its SQL."""
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_inputs(sql, extra)
        return function

    return add
