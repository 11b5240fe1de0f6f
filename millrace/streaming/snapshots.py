"""Running order states and snapshots on a stream of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.eventlog import (
    ATTRIBUTES,
    DEFAULT_CURRENCY,
    SNAPSHOT_EVERY,
    contributions,
)
from millrace.streaming.keyed import with_state
from millrace.streaming.windows import WATERMARK

# Fixed values of a new order.
_NEW = {"status": "CREATED", "customer_id": "", "total": 0.0, "currency": DEFAULT_CURRENCY}


# Statuses after which an order has no further events.
FINISHED = ("DELIVERED", "CANCELLED")


def _snapshots(every: int, keep_ms: int | None) -> tuple[Callable, Callable]:
    """Keeps the state of one order and emits it after every n-th event.

    The state is one small row per order. Events of a micro-batch are taken in the
    order of their offsets, whatever the order of the shuffle. Made inside a function
    so that it travels to the workers by value.
    """
    names, new, finished = ATTRIBUTES, _NEW, FINISHED

    def step(key, stored, due, rows, now):
        n, *values = stored or (0, *[None] * len(names))
        current = dict(zip(names, values))
        for row in sorted(rows, key=lambda r: (r.partition, r.offset)):
            n += 1
            for name in names:
                value = getattr(row, name)
                if value is not None:
                    current[name] = value
            if n % every == 0:
                shown = [new.get(a) if v is None else v for a, v in current.items()]
                yield row.order_id, row.partition, row.offset, row.version, row.at, *shown
        due = row.at // 1000 + keep_ms if keep_ms is not None and current["status"] in finished else None
        return (n, *current.values()), due

    def expire(key, stored, due):
        return None
        yield

    return step, expire


def snapshot_stream(
    events: DataFrame,
    every: int = SNAPSHOT_EVERY,
    keep_seconds: int | None = None,
    watermark: str = WATERMARK,
    buckets: int | None = None,
) -> DataFrame:
    """Snapshots as the events arrive; the same rows the batch form computes.

    With ``keep_seconds``, a delivered or cancelled order leaves the state when event time
    is that much past its last event; events must then come within the watermark. With
    ``buckets`` many orders share an entry of the state, see ``keyed``.
    """
    kept = ["order_id", "partition", "offset", "version"]
    rows = contributions(events).select(*kept, F.unix_micros("occurred_at").alias("at"), *ATTRIBUTES, "occurred_at")
    step, expire = _snapshots(every, None if keep_seconds is None else keep_seconds * 1000)
    times = {} if keep_seconds is None else {"expire": expire, "time": "occurred_at", "watermark": watermark}
    if not times:
        rows = rows.drop("occurred_at")
    output = rows.drop("occurred_at").withColumnRenamed("at", "snapshot_at").schema
    found = with_state(rows, ["order_id"], step, output, "order", buckets=buckets, **times)
    return found.withColumn("snapshot_at", F.timestamp_micros("snapshot_at"))
