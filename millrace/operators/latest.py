"""Latest row per key and newest-first reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], newest_by: list[str]) -> DataFrame:
    """One row per key, the one with the highest ``newest_by`` values.

    An aggregate, not ``row_number``: each task keeps one row per key before the
    shuffle, so a key with very many versions costs no more than any other.
    """
    values = [c for c in df.columns if c not in keys]
    row = F.max_by(F.struct(*values), F.struct(*newest_by)).alias("_row")
    return df.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*df.columns)


def compacted(log: DataFrame, keys: list[str], order: tuple[str, ...] = ("offset",)) -> DataFrame:
    """Log compaction: the last message of each key."""
    return latest_per_key(log, keys, list(order))


def newest(df: DataFrame, by: str | Column, n: int, *tie_break: str) -> DataFrame:
    """The ``n`` newest rows; Spark keeps only ``n`` rows per task for this."""
    return df.orderBy(F.desc(by) if isinstance(by, str) else by.desc(), *tie_break).limit(n)


def soft_deletes(cdc: DataFrame, n: int, *tie_break: str) -> DataFrame:
    """Operation marks of the newest changes, deletions included."""
    marked = cdc.select(
        *tie_break, "__deleted", F.col("__op"), F.col("__source_ts_ms")
    )
    return newest(marked, "__source_ts_ms", n, *tie_break)
