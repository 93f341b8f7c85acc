"""Register of the queries: a Spark plan and, where one exists, its oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from derrick.session import pin_utc

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, folder)`` under its inventory name."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(pin_utc(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
