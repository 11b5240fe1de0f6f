"""Joins that also run in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def floor_to(value: Column, step: int) -> Column:
    """Largest multiple of ``step`` not above an integral value."""
    return value - F.pmod(value, F.lit(step))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_ts: str,
    right_ts: str,
    seconds: int,
    how: str = "inner",
) -> DataFrame:
    """Pairs of one key with ``right_ts`` in ``[left_ts, left_ts + seconds]``.

    Joining on the key alone would bring all rows of a hot key to one task and
    compare them pair by pair. Time slots of the interval's length join the key: a
    left row has one slot, a right row the two slots that can hold its partners. So
    a pair meets exactly once and a key is spread over its slots. The columns of
    both sides must differ, except for the key. Watermarks carry through.
    """
    width = seconds * 1_000_000
    right_micros = F.unix_micros(right_ts)
    lefts = left.withColumn("_slot", floor_to(F.unix_micros(left_ts), width))
    rights = right.withColumnRenamed(key, "_right_key").withColumn(
        "_right_slot",
        F.explode(
            F.array(floor_to(right_micros - width, width), floor_to(right_micros, width))
        ),
    )
    reach = F.expr(f"{left_ts} + INTERVAL {seconds} SECONDS")
    condition = (
        (F.col(key) == F.col("_right_key"))
        & (F.col("_slot") == F.col("_right_slot"))
        & (F.col(right_ts) >= F.col(left_ts))
        & (F.col(right_ts) <= reach)
    )
    return lefts.join(rights, condition, how).drop("_slot", "_right_key", "_right_slot")


def enriched(
    facts: DataFrame, dimension: DataFrame, key: str, columns: list[str | Column]
) -> DataFrame:
    """Left join to a dimension with one row per key.

    No hint is given: Spark broadcasts the dimension when its bytes are few and joins by
    shuffle otherwise. Read it with ``read_dimension``, so that its size is that of files.
    """
    return facts.join(dimension, key, "left").select(*columns)
