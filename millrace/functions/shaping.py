"""Projections over orders, windows and topic names."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.schemas import MONEY


def flatten_window(df: DataFrame, window: str = "window") -> DataFrame:
    """Window struct to ``window_start, window_end``, in front."""
    rest = [c for c in df.columns if c != window]
    return df.select(
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
        *rest,
    )


def delay_seconds(later: Column, earlier: Column) -> Column:
    """Difference of the whole seconds of two timestamps."""
    return F.unix_seconds(later) - F.unix_seconds(earlier)


def items_total(items: Column) -> Column:
    """``round(sum(quantity * unit_price), 2)`` of an array of order lines."""
    summed = F.aggregate(
        items,
        F.lit(0).cast("decimal(38,6)"),
        lambda total, item: (
            total + item["quantity"] * item["unit_price"].cast("decimal(18,6)")
        ).cast("decimal(38,6)"),
    )
    return F.round(summed, 2).cast(MONEY)


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Frame in the model's column order and types.

    Absent nullable columns become null; a column that cannot be stored safely in
    the model's type fails when the plan is analyzed.
    """
    return df.to(schema)


def union_versions(*frames: DataFrame) -> DataFrame:
    """Rows of several schema versions; fields a version lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def masked(df: DataFrame, column: str) -> DataFrame:
    """Copy of the frame with one personal field replaced by its SHA-256."""
    return df.withColumn(column, F.sha2(F.col(column), 256))


def rewrite_topic(topic: Column, pattern: str, replacement: str) -> Column:
    """Topic renamed when the whole name matches, unchanged otherwise."""
    return F.regexp_replace(topic, f"^(?:{pattern})$", replacement)


def time_partitions(df: DataFrame, ts: str) -> DataFrame:
    """Year, month, day and hour of the record timestamp, zero-padded, in UTC."""
    utc = F.to_utc_timestamp(F.col(ts).cast("timestamp"), F.current_timezone())
    return df.withColumns(
        {
            "year": F.date_format(utc, "yyyy"),
            "month": F.date_format(utc, "MM"),
            "day": F.date_format(utc, "dd"),
            "hour": F.date_format(utc, "HH"),
        }
    )


def json_messages(df: DataFrame, key: str) -> DataFrame:
    """``key, value`` rows with every column as one JSON document."""
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*df.columns)).alias("value"),
    )
