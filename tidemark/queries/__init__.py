"""Named queries over the driver tables, each with an equivalent SQL where one exists."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

from tidemark.session import is_local, size_shuffles, tune
from tidemark.sinks.paths import total_bytes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

MODULES = ("relational", "windows", "quality", "staging", "modelling", "governance", "files", "streams", "ingest", "reloads")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register ``function(spark, folder)`` under ``name``."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tune(spark)
            if not is_local(spark):
                size_shuffles(spark, total_bytes(spark, folder))
            return function(spark, folder)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return function

    return register


def load_all() -> None:
    for module in MODULES:
        import_module(f"tidemark.queries.{module}")
