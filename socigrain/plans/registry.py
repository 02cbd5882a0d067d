"""Queries over the driver's tables: name -> DataFrame function, and SQL stating the same result."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ..session import tune

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def register(build: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(build)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return build(tune(spark), sf)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register
