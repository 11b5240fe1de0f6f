"""State per key, for many keys in one entry of the state store.

A state processor in Python pays some milliseconds for each group that a micro-batch
touches, and for each row some microseconds a column. With ``buckets`` the keys are dealt over
that many groups by their hash, and the rows of a bucket travel many to one: a micro-batch
pays for that many groups at most, however many keys it has. The state of a bucket is read and
written as a whole: deal the keys so where micro-batches are large, and over more buckets
where there are more keys. Without ``buckets`` every key is a group of its own.
"""

from __future__ import annotations

import pickle
from collections import namedtuple
from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

#: Buckets for micro-batches of whole tables.
BUCKETS = 1 << 9
#: Rows that a task packs by bucket at a time.
PACKED_ROWS = 100_000


def _packed(rows: DataFrame, keys: list[str], buckets: int, time: str | None) -> DataFrame:
    """``_bucket, _time, _rows``: rows of a bucket in one, with the latest of their times."""
    at = F.unix_micros(time) if time else F.lit(None).cast("bigint")
    dealt = rows.drop(time) if time else rows
    dealt = rows.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("_bucket"), at.alias("_at"), *dealt.columns)
    most = PACKED_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple]] = {}
        n = 0

        def packs() -> pa.RecordBatch:
            latest = [max((r[0] for r in of if r[0] is not None), default=None) for of in held.values()]
            return pa.record_batch(
                [pa.array(held, pa.int64()), pa.array(latest, pa.timestamp("us", "UTC")),
                 pa.array([pickle.dumps(of, pickle.HIGHEST_PROTOCOL) for of in held.values()], pa.binary())],
                ["_bucket", "_time", "_rows"],
            )

        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            for bucket, *row in zip(*columns):
                held.setdefault(bucket, []).append(tuple(row))
            n += batch.num_rows
            if n >= most:
                yield packs()
                held, n = {}, 0
        if held:
            yield packs()

    return dealt.mapInArrow(run, "_bucket bigint, _time timestamp, _rows binary")


def _processor(
    name: str,
    keys: list[str],
    step: Callable,
    output: list[str],
    expire: Callable | None,
    ttl_ms: int | None,
    columns: list[str] | None,
) -> StatefulProcessor:
    """Keeps ``{key: (state, due)}`` of a group, and the time of its one timer.

    ``columns`` are those of packed rows. Of these, rows behind the watermark are dropped
    here, as Spark drops others. Made inside a function so that it travels to the workers by value.
    """

    most = PACKED_ROWS
    places = [columns.index(k) for k in keys] if columns else keys

    def plain(value):
        """A value that finds its equal in a dictionary."""
        if isinstance(value, (list, tuple)):
            return tuple(map(plain, value))
        if isinstance(value, bytearray):
            return bytes(value)
        return "NaN" if value != value else value

    def unpacked(packs, late: int | None) -> Iterator[tuple]:
        made = namedtuple("made", columns, rename=True)._make
        for pack in packs:
            for row in pickle.loads(pack["_rows"]):
                if late is None or row[0] is None or row[0] > late:
                    yield made(row[1:])

    def shown(found: Iterator[tuple]) -> Iterator[Row]:
        """Rows as they are, or many in one where the rows came so."""
        if not columns:
            yield from map(lambda values: Row(*output)(*values), found)
            return
        while some := list(islice(found, most)):
            yield Row(_rows=pickle.dumps(some, pickle.HIGHEST_PROTOCOL))

    class Keyed(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self._handle = handle
            self._kept = handle.getValueState(name, "kept BINARY", ttl_ms)

        def _load(self) -> tuple[dict, int | None]:
            stored = self._kept.get()
            return pickle.loads(stored[0]) if stored is not None else ({}, None)

        def _store(self, kept: dict, timer: int | None) -> None:
            """A timer that is early stays: it does nothing but register the next one."""
            if expire is not None:
                due = min((d for _, d in kept.values() if d is not None), default=None)
                if timer is not None and (due is None or due < timer):
                    self._handle.deleteTimer(timer)
                    timer = None
                if due is not None and timer is None:
                    self._handle.registerTimer(due)
                    timer = due
            if kept:
                self._kept.update((pickle.dumps((kept, timer), pickle.HIGHEST_PROTOCOL),))
            else:
                self._kept.clear()

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
            return shown(self._arrived(rows, timerValues))

        def _arrived(self, rows, timerValues) -> Iterator[tuple]:
            arrived: dict[tuple, list[tuple]] = {}
            late = timerValues.getCurrentWatermarkInMs() * 1000 if expire is not None else None
            for row in unpacked(rows, late) if columns else rows:
                arrived.setdefault(tuple([plain(row[k]) for k in places]), []).append(row)
            kept, timer = self._load()
            now = timerValues.getCurrentProcessingTimeInMs() if ttl_ms else None
            if ttl_ms:
                kept = {k: entry for k, entry in kept.items() if entry[1] > now}
            changed = False
            for k, group in arrived.items():
                before = kept.get(k)
                after = yield from step(k, *(before or (None, None)), group, now)
                if after is not before and after != before:
                    kept[k], changed = after, True
            if changed:
                self._store(kept, timer)

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
            return shown(self._expired(timerValues, expiredTimerInfo))

        def _expired(self, timerValues, expiredTimerInfo) -> Iterator[tuple]:
            kept, _ = self._load()
            now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
            for k, (state, due) in list(kept.items()):
                while due is not None and due <= now:
                    entry = yield from expire(k, state, due)
                    if entry is None:
                        del kept[k]
                        break
                    kept[k] = state, due = entry
            self._store(kept, None)

        def close(self) -> None:
            pass

    return Keyed()


def with_state(
    rows: DataFrame,
    keys: list[str],
    step: Callable,
    output: str | StructType,
    name: str,
    expire: Callable | None = None,
    time: str | None = None,
    watermark: str | None = None,
    ttl_ms: int | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """What ``step`` yields for the rows of each key and micro-batch.

    ``step(key, state, due, rows, now)`` is a generator over the rows of one key, in no
    order, their values, but for ``time``, being attributes. It yields tuples of the columns of ``output`` and
    returns the new ``(state, due)``, the state being values that pickle. With
    ``expire``, the generator ``expire(key, state, due)`` runs once event time, the column
    ``time`` less the ``watermark``, has passed ``due``, in milliseconds; it returns the next
    ``(state, due)``, or None to forget the key. With ``ttl_ms`` a key is forgotten when
    processing time, ``now``, reaches its ``due``, which is that much ahead at most.
    """
    columns = [c for c in rows.columns if c != time] if buckets else None
    kind = rows.sparkSession.createDataFrame([], output).schema
    if buckets:
        rows, time = _packed(rows, keys, buckets, time), time and "_time"
    if time:
        rows = rows.withWatermark(time, watermark)
    found = rows.groupBy(*(["_bucket"] if buckets else keys)).transformWithState(
        statefulProcessor=_processor(name, keys, step, kind.names, expire, ttl_ms, columns),
        outputStructType="_rows binary" if buckets else kind,
        outputMode="Append",
        timeMode="EventTime" if expire else "ProcessingTime" if ttl_ms else "None",
    )
    return _unpacked(found, kind) if buckets else found


def _unpacked(packs: DataFrame, kind: StructType) -> DataFrame:
    types = packs.sparkSession.createDataFrame([], kind).toArrow().schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pack in batch.column(0):
                columns = zip(*pickle.loads(pack.as_py()))
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, types)], types.names)

    return packs.mapInArrow(run, kind)
