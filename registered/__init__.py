"""The registered queries: each runs a library operator on the driver's tables, next to the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None):
        def register(function: Query) -> Query:
            key = name or function.__name__
            self.queries[key] = function
            if sql is not None:
                self.sql[key] = sql
            return function

        return register


def all_queries() -> Registry:
    from registered import aggregates, joins, nested, plans, projections, scalars, tables

    merged = Registry()
    for module in (tables, projections, joins, aggregates, nested, scalars, plans):
        merged.queries |= module.registry.queries
        merged.sql |= module.registry.sql
    return merged
