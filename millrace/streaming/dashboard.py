"""Orders per day and status, kept up to date on a stream of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.eventlog import contributions
from millrace.streaming.keyed import with_state
from millrace.streaming.sinks import FILE_TRIGGER, with_trigger

_CHANGE = "day DATE, status STRING, n INT"


def _moves() -> Callable:
    """Remembers the cell of an order. When it moves, it is taken out of its old cell and
    put into the new one. Made inside a function so that it travels to the workers by value."""

    def step(key, old, due, rows, now):
        new = old
        for row in sorted(rows, key=lambda r: (r.partition, r.offset)):
            place = (row.partition, row.offset)
            if new is not None and place <= new[:2]:
                continue  # delivered again
            status = row.status or (new[3] if new else "CREATED")
            new = (*place, row.day, status)
        if old is None or old[2:] != new[2:]:
            if old is not None:
                yield old[2], old[3], -1
            yield new[2], new[3], 1
        return new, None

    return step


def dashboard_changes(events: DataFrame, buckets: int | None = None) -> DataFrame:
    """``day, status, n``: 1 for an order that enters a cell, -1 for one that leaves it."""
    rows = contributions(events).select(
        "order_id",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.to_date("occurred_at").alias("day"),
        "status",
    )
    return with_state(rows, ["order_id"], _moves(), _CHANGE, "cell", buckets=buckets)


def dashboard_stream(
    events: DataFrame,
    table: str,
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
    buckets: int | None = None,
) -> StreamingQuery:
    """Stores what each micro-batch changes, one row for each cell it touches. A batch that
    runs again replaces its own rows."""

    def write(batch: DataFrame, batch_id: int) -> None:
        changed = batch.groupBy("day", "status").agg(F.sum("n").alias("n")).filter("n <> 0")
        changed.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    writer = dashboard_changes(events, buckets).writeStream.foreachBatch(write)
    return with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def read_dashboard(spark: SparkSession, table: str) -> DataFrame:
    """``day, status, n_orders`` now, without empty cells."""
    rows = spark.read.schema("day DATE, status STRING, n BIGINT").parquet(f"{table}/batch=*")
    return rows.groupBy("day", "status").agg(F.sum("n").alias("n_orders")).filter("n_orders <> 0")
