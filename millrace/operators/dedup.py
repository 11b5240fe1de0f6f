"""Duplicate removal in batch. Each task drops its own copies before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_versions(cdc: DataFrame, keys: tuple[str, ...] = ("order_id", "cdc_ts_ms")) -> DataFrame:
    """One row per key and version; re-emitted copies are identical, so any will do."""
    return cdc.dropDuplicates(list(keys))


def once_per_event(events: DataFrame) -> DataFrame:
    """First delivery of each ``event_id``."""
    return first_per_key(events, ["event_id"])


def first_per_key(
    events: DataFrame, keys: list[str], order: tuple[str, ...] = ("partition", "offset")
) -> DataFrame:
    """Earliest row of each key: acting once per order means acting on this row."""
    values = [c for c in events.columns if c not in keys]
    row = F.min_by(F.struct(*values), F.struct(*order)).alias("_row")
    return events.groupBy(*keys).agg(row).select(*keys, "_row.*").select(*events.columns)
