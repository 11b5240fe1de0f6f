"""CDC column expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metadata columns added by the unwrap step and their short names.
RENAMED_METADATA = {"__op": "op", "__source_ts_ms": "cdc_ts_ms"}
DELETE_OP = "d"


def event_time(cdc_ts_ms: Column) -> Column:
    """Event time of an epoch-millisecond column, with its milliseconds kept."""
    return F.timestamp_millis(cdc_ts_ms)


def flatten_decoded(df: DataFrame, data: str = "data") -> DataFrame:
    """Decoded struct as columns; CDC metadata also under its short name."""
    fields = df.schema[data].dataType.fieldNames()
    renamed = [
        F.col(f"{data}.{long}").alias(short)
        for long, short in RENAMED_METADATA.items()
        if long in fields
    ]
    others = [c for c in df.columns if c != data]
    key = [c for c in others if c == "kafka_key"]
    rest = [c for c in others if c != "kafka_key"]
    return df.select(*key, f"{data}.*", *renamed, *rest)


def with_lineage(
    df: DataFrame, layer: str, ingested_at: datetime | Column | None = None
) -> DataFrame:
    """Ingestion time and layer name; pass a time to make a run repeatable."""
    stamp = F.current_timestamp() if ingested_at is None else ingested_at
    if not isinstance(stamp, Column):
        stamp = F.lit(stamp)
    return df.withColumns({"ingested_at": stamp, "bronze_layer": F.lit(layer)})


def unwrap(df: DataFrame, table: Column | None = None) -> DataFrame:
    """``{before, after, source, op, ts_ms}`` to one flat row per change.

    Deletes keep the last known row and are marked ``__deleted='true'``; rows with
    neither image (tombstones) are not emitted. Without ``table`` the name is that of the
    source, or of its connector where the source has no table.
    """
    if table is None:
        named = "table" in df.schema["source"].dataType.names
        table = F.col("source.table" if named else "source.name")
    deleted = F.col("op") == DELETE_OP
    image = F.when(deleted, F.col("before")).otherwise(F.col("after"))
    kept = [c for c in df.columns if c not in ("before", "after", "source", "op", "ts_ms")]
    return (
        df.select(*kept, "source", "op", image.alias("_image"))
        .filter(F.col("_image").isNotNull())
        .select(
            *kept,
            "_image.*",
            F.when(deleted, "true").otherwise("false").alias("__deleted"),
            F.col("op").alias("__op"),
            table.alias("__table"),
            F.col("source.ts_ms").alias("__source_ts_ms"),
            F.col("source.lsn").alias("__source_lsn"),
        )
    )
