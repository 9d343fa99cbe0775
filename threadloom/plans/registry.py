"""Catalog of registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Query
    sql: str | None


CATALOG: dict[str, Entry] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its inventory name with its equivalent SQL."""

    def register(run: Query) -> Query:
        if name in CATALOG:
            raise ValueError(f"query {name!r} is registered twice")
        CATALOG[name] = Entry(run, sql)
        return run

    return register


def queries() -> dict[str, Query]:
    return {name: entry.run for name, entry in CATALOG.items()}


def oracles() -> dict[str, str]:
    return {name: entry.sql for name, entry in CATALOG.items() if entry.sql is not None}
