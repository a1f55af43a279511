"""Registered queries with, where SQL can say it, the same query as SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelweave.queries.inputs import with_inputs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, inputs: str = "") -> Callable[[Query], Query]:
    """Registers a function under its own name."""

    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = with_inputs(inputs, sql) if inputs else sql
        return fn

    return add
