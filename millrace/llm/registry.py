"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            return run(spark, folder.rstrip("/"))

        prepared.__name__ = name
        prepared.__doc__ = run.__doc__
        QUERIES[name] = prepared
        if check:
            CHECKS[name] = check
        return run

    return register
