"""Named queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query; without SQL the check only looks at its rows."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register
