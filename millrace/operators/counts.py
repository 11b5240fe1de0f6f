"""Counts over bronze and silver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def total_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total_rows"))


def count_by_op(df: DataFrame, by_count: bool = False) -> DataFrame:
    counted = df.groupBy("op").agg(F.count("*").alias("n"))
    return counted.orderBy(F.desc("n"), "op") if by_count else counted.orderBy("op")


def rows_per_partition(
    df: DataFrame, columns: tuple[str, ...] = ("year", "month", "day")
) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n_rows")).orderBy(*columns)


def payment_latency(paid: DataFrame) -> DataFrame:
    """Paid orders and their mean delay. The sum stays integral, so it is exact."""
    return paid.agg(
        F.count("*").alias("paid_orders"),
        (F.sum("delay_seconds").cast("double") / F.count("*")).alias("avg_delay_seconds"),
    )


def orders_by_day_and_status(states: DataFrame, at: str = "occurred_at") -> DataFrame:
    """Orders per day and current status, from latest states."""
    return states.groupBy(F.to_date(at).alias("day"), "status").agg(
        F.count("*").alias("n_orders")
    )
