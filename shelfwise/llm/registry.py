"""Queries of this subpackage and their SQL, filled by the operator modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.common import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a (spark, sf_dir) function under a name, with SQL where there is some."""

    def put(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(small_batches(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return function

    return put
