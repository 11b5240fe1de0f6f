import time
import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import framing
from millrace.plans.jobs import bronze_job
from millrace.schemas import CDC_ORDER, ENVELOPE
from millrace.sources import envelope as E
from millrace.streaming import dedup, joins, sinks, windows
from millrace.streaming.snapshots import snapshot_stream
from millrace.streaming.upsert import compact, history, read_current, read_state, upsert_stream


def at(text: str) -> datetime:
    return datetime.fromisoformat(f"2024-05-01T{text}").replace(tzinfo=timezone.utc)


def batches(spark, folder, schema, rows_per_batch):
    """One file per batch, listed in the order they were written."""
    for rows in rows_per_batch:
        df = spark.createDataFrame(rows, schema)
        df.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.02)
    typed = spark.createDataFrame([], schema).schema
    return E.file_stream(spark, str(folder), typed, max_files_per_trigger=1)


def drain(df, folder, mode="append"):
    query = sinks.append_table(df, f"{folder}/out", f"{folder}/ck", every=None)
    query.awaitTermination()
    return query, df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out").collect()


TIMED = "ts TIMESTAMP, id INT"
LATE = [(at(t), 1) for t in ("10:08:30", "10:09:30", "10:10:30", "10:12:00")]


@pytest.mark.parametrize(
    "between, kept, dropped",
    [([], {"10:08", "10:09", "10:10", "10:12"}, 0), ([[(at("10:20:01"), 1)]], {"10:10", "10:12"}, 2)],
)
def test_late_rows(spark, tmp_path, between, kept, dropped):
    stream = batches(
        spark, tmp_path / "in", TIMED,
        [[(at("10:20:00"), 1)], *between, LATE, [(at("10:40:00"), 1)]],
    )
    query, rows = drain(
        windows.counts_by_window(stream, "ts", "1 minute", "10 minutes"), tmp_path
    )
    starts = {r["window_start"].strftime("%H:%M") for r in rows}
    assert starts & {"10:08", "10:09", "10:10", "10:12"} == kept
    assert sum(r[4] for r in sinks.progress_rows(query)) == dropped


def test_session_windows(spark, tmp_path):
    first = [(at("10:00:00"), 1), (at("10:29:59"), 1), (at("10:59:59"), 1), (at("10:00:00"), 2)]
    stream = batches(spark, tmp_path / "in", TIMED, [first, [(at("15:00:00"), 9)]])
    _, rows = drain(windows.sessions(stream, "id", "ts"), tmp_path)
    closed = {(1, "11:29:59", 3), (2, "10:30:00", 1)}
    assert {(r["id"], str(r["window_end"])[11:], r["n_events"]) for r in rows} == closed
    stored = windows.sessions(spark.createDataFrame(first, TIMED), "id", "ts").collect()
    assert {(r["id"], str(r["window_end"])[11:], r["n_events"]) for r in stored} == closed


@pytest.mark.parametrize("how", ["inner", "left_outer"])
def test_interval_join_bounds(spark, tmp_path, how):
    orders = batches(
        spark, tmp_path / "o", "order_id INT, customer_id INT, total_amount DOUBLE, kafka_ts TIMESTAMP",
        [
            [(1, 1, 1.0, at("10:00:00")), (2, 1, 1.0, at("10:01:00")), (3, 1, 1.0, at("10:02:00"))],
            [(9, 1, 1.0, at("12:00:00"))],
            [(10, 1, 1.0, at("13:00:00"))],
        ],
    )
    payments = batches(
        spark, tmp_path / "p", "order_id INT, amount DOUBLE, kafka_ts TIMESTAMP",
        [
            [(1, 1.0, at("10:15:00")), (2, 1.0, at("10:16:01"))],
            [(9, 1.0, at("12:00:08"))],
            [(99, 1.0, at("13:00:00"))],
        ],
    )
    _, rows = drain(joins.orders_with_payments(orders, payments, how=how), tmp_path)
    expected = {(1, 900), (9, 8)}
    if how == "left_outer":
        expected |= {(2, None), (3, None)}
    assert {(r["order_id"], r["delay_seconds"]) for r in rows} == expected


def test_dedup_state_shrinks(spark, tmp_path):
    def ms(text):
        return int(at(text).timestamp() * 1000)

    stream = batches(
        spark, tmp_path / "in", "order_id INT, cdc_ts_ms BIGINT",
        [[(1, ms("10:00:00"))] * 2, [(2, ms("11:00:00"))], [(3, ms("12:00:00"))]],
    )
    query, rows = drain(dedup.cdc_versions(stream), tmp_path)
    assert sorted(r["order_id"] for r in rows) == [1, 2, 3]
    assert max(r[3] for r in sinks.progress_rows(query)) == 2


CHANGES = "order_id INT, op STRING, cdc_ts_ms BIGINT, partition INT, offset BIGINT, status STRING"


def test_upserts_in_any_portions(spark, tmp_path):
    changes = [
        [(1, "c", 10, 0, 1, "new"), (2, "c", 10, 0, 2, "new"), (3, "c", 10, 0, 3, "new")],
        [(1, "u", 20, 0, 4, "paid"), (2, "d", 30, 0, 5, "gone"), (1, "u", 25, 0, 6, "sent")],
        # An older update after the delete must not bring the row back.
        [(2, "u", 20, 0, 7, "late"), (3, "u", 5, 0, 8, "older")],
    ]
    stream = batches(spark, tmp_path / "in", CHANGES, changes)
    table = f"{tmp_path}/orders"
    upsert_stream(stream, table, f"{tmp_path}/ck", ["order_id"], every=None).awaitTermination()

    def current():
        return {(r["order_id"], r["status"]) for r in read_current(spark, table, ["order_id"]).collect()}

    assert current() == {(1, "sent"), (3, "new")}
    assert {r["order_id"] for r in read_state(spark, table, ["order_id"]).collect()} == {1, 2, 3}
    first = read_current(spark, table, ["order_id"], version=0)
    assert {r["status"] for r in first.collect()} == {"new"}
    merges = [r["version"] for r in history(spark, table).collect()]
    assert merges == [2, 1, 0]

    assert compact(spark, table, ["order_id"]) == 2
    assert current() == {(1, "sent"), (3, "new")}
    # Applied again from the start under a new name: the same state.
    again = E.file_stream(spark, f"{tmp_path}/in", stream.schema)
    upsert_stream(again, f"{tmp_path}/b", f"{tmp_path}/ck2", ["order_id"], every=None).awaitTermination()
    other = read_current(spark, f"{tmp_path}/b", ["order_id"]).collect()
    assert {(r["order_id"], r["status"]) for r in other} == {(1, "sent"), (3, "new")}
    # With a new base after every second batch: the deletion mark lies in the base.
    third = E.file_stream(spark, f"{tmp_path}/in", stream.schema, max_files_per_trigger=1)
    table = f"{tmp_path}/c"
    upsert_stream(third, table, f"{tmp_path}/ck3", ["order_id"], every=None, compact_every=2).awaitTermination()
    assert current() == {(1, "sent"), (3, "new")}
    kinds = [(r["version"], r["operation"]) for r in history(spark, table).collect()]
    assert sorted(kinds) == [(0, "MERGE"), (1, "COMPACT"), (1, "MERGE"), (2, "MERGE")]
    assert compact(spark, table, ["order_id"]) == compact(spark, table, ["order_id"]) == 2


def framed(document: str) -> bytes:
    return framing.MAGIC + (7).to_bytes(4, "big") + document.encode()


def message(offset, value, topic="orders"):
    return (b"k", value, topic, 0, offset, at("10:00:00"), 0)


def test_bronze_job_restarts_and_keeps_dead_letters(spark, tmp_path):
    good = '{"order_id": 1, "status": "paid", "__op": "u", "__source_ts_ms": 5}'
    source = tmp_path / "in"
    values = [framed(good), None, b"\0\0\0\0", framed(""), good.encode(), framed("{oops")]
    batches(spark, source, ENVELOPE, [[message(i, v) for i, v in enumerate(values)]])
    args = [f"{tmp_path}/{x}" for x in ("orders", "ck", "dead")]

    def run():
        stream = E.file_stream(spark, str(source))
        bronze_job(stream, *args, every=None, ingested_at=datetime(2024, 1, 1)).awaitTermination()
        return spark.read.parquet(args[0]), spark.read.parquet(args[2])

    rows, dead = run()
    row = rows.first()
    assert (row["order_id"], row["op"], row["cdc_ts_ms"], row["kafka_key"]) == (1, "u", 5, "k")
    assert {r["offset"]: r["error_class"] for r in dead.collect()} == {
        1: "tombstone", 2: "short_frame", 3: "empty_payload", 4: "bad_magic", 5: "undecodable",
    }
    batches(spark, source, ENVELOPE, [[message(9, framed(good))]])
    rows, dead = run()
    assert rows.count() == 2 and dead.count() == 5


def test_bronze_job_honours_its_sink(spark, tmp_path):
    good = '{"order_id": 1, "status": "paid", "__op": "u", "__source_ts_ms": 5}'
    wrong = ['{"order_id": "x"}', good + " junk", '{"status": "paid"}', '{"order_id": 1, "status"']
    rows = [message(i, framed(v)) for i, v in enumerate([good, *wrong])]
    batches(spark, tmp_path / "in", ENVELOPE, [rows])
    stream = E.file_stream(spark, f"{tmp_path}/in")
    args = [f"{tmp_path}/{x}" for x in ("orders", "ck", "dead")]
    with pytest.raises(ValueError):
        bronze_job(stream, *args, every=None, sink="nonsense")
    with pytest.raises(ValueError):
        bronze_job(stream, *args, every=None, sink="kafka")
    bronze_job(stream, *args, every=None, sink="kafka", folder=f"{tmp_path}/out").awaitTermination()
    sent = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [r["key"] for r in sent] == ["k"] and '"order_id":1' in sent[0]["value"]
    assert {r["offset"] for r in spark.read.parquet(args[2]).collect()} == {1, 2, 3, 4}
    assert not (tmp_path / "orders").exists()


def test_progress_log_keeps_every_batch(spark, tmp_path):
    log = sinks.ProgressLog(spark, f"{tmp_path}/log", rows_per_file=2)
    stream = batches(spark, tmp_path / "in", TIMED, [[(at("10:00:00"), i)] for i in range(5)])
    query = sinks.append_table(stream, f"{tmp_path}/t", f"{tmp_path}/ck", every=None, name="kept")
    query.awaitTermination()
    rows = log.close().filter(F.col("run") == str(query.runId)).orderBy("batch_id").collect()
    assert [tuple(r)[0:1] + tuple(r)[2:] for r in rows] == sinks.progress_rows(query)
    assert len(rows) == 5


def test_strict_job_fails_on_the_first_broken_message(spark, tmp_path):
    batches(spark, tmp_path / "in", ENVELOPE, [[message(0, b"plain")]])
    stream = E.file_stream(spark, f"{tmp_path}/in")
    query = bronze_job(stream, f"{tmp_path}/t", f"{tmp_path}/ck", every=None)
    with pytest.raises(Exception, match="bad_magic"):
        query.awaitTermination()


def test_history_and_time_travel(spark, tmp_path):
    stream = batches(spark, tmp_path / "in", TIMED, [[(at("10:00:00"), 1)], [(at("10:01:00"), 2)] * 2])
    table = f"{tmp_path}/t"
    sinks.append_with_history(stream, table, f"{tmp_path}/ck", every=None).awaitTermination()
    assert [(r["version"], r["num_rows"]) for r in sinks.history(spark, table).collect()] == [(1, 2), (0, 1)]
    assert sinks.read_committed(spark, table).count() == 3
    assert sinks.read_committed(spark, table, 0).count() == 1


def test_sink_choice(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.bronze_sink(None, "other")
    stream = batches(spark, tmp_path / "in", TIMED, [[(at("10:00:00"), 1)]])
    sinks.republish_json(
        stream, "id", f"{tmp_path}/ck", every=None, folder=f"{tmp_path}/out"
    ).awaitTermination()
    row = spark.read.parquet(f"{tmp_path}/out").first()
    assert row["key"] == "1" and '"id":1' in row["value"]


def test_snapshots_continue_across_batches(spark, tmp_path):
    schema = (
        "event_id STRING, order_id STRING, occurred_at TIMESTAMP, version INT, event_type STRING, "
        "partition INT, offset BIGINT, customer_id STRING, total DOUBLE, currency STRING, "
        "transaction_id STRING, reason STRING, reservation_id STRING, tracking_number STRING"
    )

    def event(i, kind, **fields):
        names = [f.split()[0] for f in schema.split(", ")]
        row = {"event_id": str(i), "order_id": "o", "occurred_at": at("10:00:00"), "version": i,
               "event_type": kind, "partition": 0, "offset": i, **fields}
        return tuple(row.get(n) for n in names)

    stream = batches(
        spark, tmp_path / "in", schema,
        [
            [event(1, "OrderCreated", customer_id="c", total=5.0), event(2, "PaymentCompleted", transaction_id="t")],
            [event(3, "StockReserved", reservation_id="r")],
        ],
    )
    _, rows = drain(snapshot_stream(stream, every=3), tmp_path)
    assert [(r["version"], r["status"], r["customer_id"], r["transaction_id"], r["total"]) for r in rows] == [
        (3, "RESERVED", "c", "t", 5.0)
    ]
