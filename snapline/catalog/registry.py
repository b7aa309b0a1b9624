"""Registered queries: each has a Spark plan and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from snapline.session import size_shuffles, tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query under ``name`` with its check; the session is tuned and sized before it runs."""

    def register(function: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            size_shuffles(tune(spark), sf_dir)
            return function(spark, sf_dir)

        QUERIES[name] = run
        SQL[name] = sql
        return function

    return register
