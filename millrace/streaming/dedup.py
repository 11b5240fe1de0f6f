"""Duplicate removal on streams, with state that shrinks as the watermark moves."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.cdc import event_time
from millrace.streaming.keyed import with_state
from millrace.streaming.windows import WATERMARK


def thinned(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drops copies within each Arrow batch, before the shuffle to the state.

    Worth its Python step where one message may be repeated very often: all copies
    of a message go to the same state partition.
    """

    def first_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.drop_duplicates(keys)

    return df.mapInPandas(first_of_batch, df.schema)


def cdc_versions(
    cdc: DataFrame,
    keys: tuple[str, ...] = ("order_id", "cdc_ts_ms"),
    watermark: str = WATERMARK,
    thin: bool = False,
) -> DataFrame:
    """One row per key and version; identical re-emissions collapse.

    The event time is one of the keys: it follows from ``cdc_ts_ms``, so the result is
    the same, and only state keyed by it is released.
    """
    if thin:
        cdc = thinned(cdc, list(keys))
    timed = cdc.withColumn("event_time", event_time(F.col("cdc_ts_ms")))
    if cdc.isStreaming:
        timed = timed.withWatermark("event_time", watermark)
    return timed.dropDuplicates([*keys, "event_time"])


def once_within_watermark(
    events: DataFrame, keys: list[str], ts: str, watermark: str = WATERMARK
) -> DataFrame:
    """First row per key; copies may have other times, within the watermark delay."""
    return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark(keys)


def _first_only(ttl_ms: int) -> Callable:
    """Emits the first row of a key and remembers the key for some time.

    Made inside a function so that it travels to the workers by value.
    """

    def step(key, seen, due, rows, now):
        if seen:
            return seen, due
        yield tuple(rows[0])
        return True, now + ttl_ms

    return step


def first_with_ttl(df: DataFrame, keys: list[str], ttl_ms: int, buckets: int | None = None) -> DataFrame:
    """Custom-state form: a key counts as seen for ``ttl_ms`` of processing time. With
    ``buckets`` many keys share an entry of the state, see ``keyed``."""
    return with_state(df, keys, _first_only(ttl_ms), df.schema, "seen", ttl_ms=ttl_ms, buckets=buckets)
