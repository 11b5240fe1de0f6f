"""An orchestrated saga on a stream: commands from state, and from silence."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.eventlog import STATUS_AFTER
from millrace.operators.saga import CANCEL_REASONS, NEXT_COMMAND
from millrace.streaming.keyed import with_state
from millrace.streaming.windows import WATERMARK

CANCEL, REFUND, RELEASE = "CancelOrder", "RefundPayment", "ReleaseStock"
TIMED_OUT = "timed_out"
TIMEOUT_SECONDS = 15 * 60
KEEP_SECONDS = 24 * 3600

_COMMAND = "order_id {}, command STRING, reason STRING, at BIGINT"
_SAGA = ("status", "partition", "offset", "transaction_id", "reservation_id", "sent")


def _orchestrator(timeout_ms: int, keep_ms: int) -> tuple[Callable, Callable]:
    """What events and silence do to a saga: where it stands, what it holds, what was sent.

    Made inside a function so that both travel to the workers by value.
    """
    after, forward, refused = STATUS_AFTER, NEXT_COMMAND, CANCEL_REASONS
    cancel, refund, release, timed_out = CANCEL, REFUND, RELEASE, TIMED_OUT
    names = _SAGA

    def commands(saga: dict, key, at, reason: str | None) -> Iterator[tuple]:
        """What the saga calls for and has not been sent yet."""
        wanted = [forward[saga["status"]]] if saga["status"] in forward else []
        if saga["status"] == "CANCELLED":
            wanted = [cancel] if reason else []
            wanted += [refund] * (saga["transaction_id"] is not None)
            wanted += [release] * (saga["reservation_id"] is not None)
        for command in wanted:
            if command not in saga["sent"]:
                saga["sent"] += (command,)
                yield key, command, reason, at

    def silent(saga: dict, key, due: int) -> Iterator[tuple]:
        saga["status"] = "CANCELLED"
        yield from commands(saga, key, due * 1000, timed_out)

    def step(key, stored, due, rows, now):
        saga, heard = dict(zip(names, stored or (None, None, None, None, None, ()))), False
        order = rows[0].order_id
        for row in sorted(rows, key=lambda r: (r.partition, r.offset)):
            place, at = (row.partition, row.offset), row.at // 1000
            if saga["offset"] is not None and place <= (saga["partition"], saga["offset"]):
                continue  # delivered again
            if saga["status"] in forward and due is not None and at > due:
                # The answer is too late, though no timer has run out yet.
                yield from silent(saga, order, due)
            saga["partition"], saga["offset"] = place
            kind, reason, heard = row.event_type, None, True
            saga["transaction_id"] = saga["transaction_id"] or row.transaction_id
            saga["reservation_id"] = saga["reservation_id"] or row.reservation_id
            if saga["status"] != "CANCELLED":
                if kind in refused:
                    saga["status"], reason = "CANCELLED", refused[kind]
                else:
                    saga["status"] = after.get(kind, saga["status"])
            # A payment that comes after the cancellation is refunded too.
            yield from commands(saga, order, row.at, reason)
            due = at + (timeout_ms if saga["status"] in forward else keep_ms)
        return (tuple(saga.values()), due) if heard else (stored, due)

    def expire(key, stored, due):
        saga = dict(zip(names, stored))
        if saga["status"] not in forward:
            return None
        yield from silent(saga, key[0], due)
        return tuple(saga.values()), due + keep_ms

    return step, expire


def saga_commands(
    events: DataFrame,
    timeout_seconds: int = TIMEOUT_SECONDS,
    keep_seconds: int = KEEP_SECONDS,
    watermark: str = WATERMARK,
    buckets: int | None = None,
) -> DataFrame:
    """``order_id, command, reason, at``: every command once, as the events arrive.

    ``events``: order_id, partition, offset, event_type, occurred_at, transaction_id and
    reservation_id. An order that waits for an answer longer than ``timeout_seconds`` of
    event time is cancelled, and what it holds is given back. Events that are delivered
    again change nothing. A finished saga leaves the state after ``keep_seconds``. With
    ``buckets`` many sagas share an entry of the state, see ``keyed``.
    """
    timed = events.select(
        "order_id",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "event_type",
        "occurred_at",
        F.unix_micros("occurred_at").alias("at"),
        "transaction_id",
        "reservation_id",
    )
    kind = events.schema["order_id"].dataType.simpleString()
    step, expire = _orchestrator(timeout_seconds * 1000, keep_seconds * 1000)
    commands = with_state(
        timed, ["order_id"], step, _COMMAND.format(kind), "saga", expire, "occurred_at", watermark, buckets=buckets
    )
    return commands.withColumn("at", F.timestamp_micros("at"))
