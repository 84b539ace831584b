"""Registered queries over the test tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Queries by name, with their oracle SQL where there is one."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, oracle: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(function: Query) -> Query:
            key = name or function.__name__
            self.queries[key] = function
            if oracle is not None:
                self.oracles[key] = oracle
            return function

        return register

    def include(self, other: Catalog) -> None:
        self.queries.update(other.queries)
        self.oracles.update(other.oracles)


def full_catalog() -> Catalog:
    from arborsync.catalog import changes, columns, content, crawling, history, snapshots, streams

    everything = Catalog()
    for module in (snapshots, changes, content, crawling, history, columns, streams):
        everything.include(module.CATALOG)
    return everything
