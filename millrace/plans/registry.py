"""Registered queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.runtime import work_folder
from millrace.streaming.sinks import append_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    """Registers a query, with the SQL that gives the same rows where there is one."""

    def register(run: Query) -> Query:
        def prepared(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            # Lets AQE split the hot partition of a join that feeds an aggregate.
            spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
            return run(spark, folder.rstrip("/"))

        prepared.__name__ = name
        prepared.__doc__ = run.__doc__
        QUERIES[name] = prepared
        if check:
            CHECKS[name] = check
        return run

    return register


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the form the stored tables use."""
    zoned = [f.name for f in df.schema if f.dataType.typeName() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def drained(df: DataFrame, name: str) -> DataFrame:
    """Runs a streaming query over all data there is and returns what it wrote."""
    spark = df.sparkSession
    folder = work_folder(spark, name)
    append_table(df, f"{folder}/table", f"{folder}/checkpoint", every=None).awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{folder}/table")
