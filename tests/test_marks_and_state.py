"""Stored marks, tails, ledgers and expiring state, with crashes and late arrivals."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import eventlog, metrics
from millrace.operators.stock import reserve
from millrace.plans import inputs
from millrace.runtime import ROCKSDB_PROVIDER
from millrace.sources import bounded
from millrace.streaming import sinks
from millrace.streaming import stock as ledger
from millrace.streaming.joins import paid_items
from millrace.streaming.orchestrator import saga_commands
from millrace.streaming.snapshots import snapshot_stream

LOG = (
    "order_id BIGINT, partition INT, offset BIGINT, version INT, event_type STRING, occurred_at TIMESTAMP, "
    "customer_id STRING, total DOUBLE, currency STRING, transaction_id STRING, reservation_id STRING, "
    "tracking_number STRING, reason STRING"
)
KINDS = ("OrderCreated", "PaymentCompleted", "StockReserved", "OrderShipped", "OrderCancelled")


def event_log(n=900):
    """Orders on three log partitions, some quiet from early on."""
    rng, ends, versions, rows = random.Random(6), [0, 0, 0], {}, []
    for i in range(n):
        order = rng.randrange(60) if i < 200 else rng.randrange(20)
        p, kind = order % 3, rng.choice(KINDS)
        versions[order] = versions.get(order, 0) + 1
        rows.append(
            (order, p, ends[p], versions[order], kind, datetime(2024, 1, 1) + timedelta(seconds=i), f"c{i}",
             float(i), "EUR", f"t{i}", f"r{i}", f"n{i}", f"x{i}")
        )
        ends[p] += 1
    return rows


def test_snapshots_and_tail_equal_a_full_replay(spark, tmp_path):
    """The log loses what lies before the marks after each run; the second run crashes
    before its marks are stored and is repeated."""
    rows = event_log()
    whole = spark.createDataFrame(rows, LOG)
    left = whole.filter("false")
    for run, upto in enumerate((100, 200, 300)):
        seen = {(r[1], r[2]) for r in rows if upto - 100 <= r[2] < upto}
        arrived = spark.createDataFrame([r for r in rows if (r[1], r[2]) in seen], LOG)
        left.unionByName(arrived).write.parquet(f"{tmp_path}/log{run}")
        log = spark.read.parquet(f"{tmp_path}/log{run}")
        if run == 1:
            with pytest.MonkeyPatch.context() as patch:
                patch.setattr(eventlog, "MARKS", "run STRING, nothing BIGINT")
                with pytest.raises(Exception):
                    eventlog.write_snapshots(log, f"{tmp_path}/s", keep=40)
        marks = eventlog.write_snapshots(log, f"{tmp_path}/s", keep=40)
        ends = {p: max(r[2] for r in rows if r[1] == p and r[2] < upto) + 1 for p in range(3)}
        assert all(ends[p] - 41 <= low <= ends[p] for p, low in marks.items()), marks
        left = eventlog.tail_of(log, marks)
        assert left.count() < log.count() / 2
        done = whole.filter(F.col("offset") < upto)
        want = sorted(map(str, eventlog.fold(done).collect()))
        got = eventlog.bootstrap_stored(f"{tmp_path}/s", left)
        assert sorted(map(str, got.select(eventlog.fold(done).columns).collect())) == want


def test_outbox_polls(spark, tmp_path):
    published, fail = {}, [True]

    def publish(rows, poll):
        published[poll] = sorted(r.id for r in rows.collect())
        if fail:
            fail.clear()
            raise ConnectionError

    def outbox(n):
        return spark.range(1, n + 1)

    with pytest.raises(ConnectionError):
        bounded.poll_outbox(outbox(5), "id", f"{tmp_path}/marks", publish)
    # Rows that arrive after the crash belong to the poll that is repeated.
    assert bounded.poll_outbox(outbox(7), "id", f"{tmp_path}/marks", publish) == 7
    assert bounded.poll_outbox(outbox(7), "id", f"{tmp_path}/marks", publish) == 7
    assert bounded.poll_outbox(outbox(9), "id", f"{tmp_path}/marks", publish) == 9
    assert published == {1: [1, 2, 3, 4, 5, 6, 7], 2: [8, 9]}


def test_batches_against_standing_balances_equal_one_run(spark, tmp_path):
    rng, rows = random.Random(8), []
    for o in range(120):
        skus = rng.sample(["a", "b", "c", "d", "e"], rng.choice([1, 1, 2, 3]))
        items = [(s, rng.randint(1, 6)) for s in skus]
        rows.append((o, "request", 10 * o, 0, o, items))
        for later in rng.sample([15, 125, 425], rng.choice([0, 0, 1, 2])):
            rows.append((o, "release", 10 * o + later, 0, o, None))
    schema = (
        "order_id BIGINT, kind STRING, at BIGINT, partition INT, offset BIGINT, "
        "items ARRAY<STRUCT<sku: STRING, quantity: INT>>"
    )
    stock = spark.createDataFrame([(s, 40 + 10 * i) for i, s in enumerate("abcd")], "sku STRING, quantity BIGINT")
    entries = spark.createDataFrame(rows, schema)
    lines = entries.filter("kind = 'request'").select(
        "order_id", "at", "partition", "offset", F.posexplode("items").alias("line_no", "i")
    )
    demands = lines.select("order_id", "at", "partition", "offset", "line_no", "i.*")
    releases = entries.filter("kind = 'release'").select("order_id", "at", "partition", "offset")
    want = sorted(map(tuple, reserve(demands, stock, releases).collect()))

    home = f"{tmp_path}/ledger"
    ledger.open_ledger(home, stock)
    for i in range(4):
        batch = entries.filter(F.floor(F.col("at") / 310) == i) if i < 3 else entries.filter("at >= 930")
        for _ in range(2 if i == 2 else 1):  # the third batch runs again
            ledger.apply_batch(home, batch, i)
        if i == 1:
            ledger.compact(spark, home, 1)
    got = ledger.decisions(spark, home)
    assert sorted(map(tuple, got.select("order_id", "offset", "event_type", "missing_sku").collect())) == want
    left = {r.sku: r.quantity for r in ledger.balances(spark, home).collect()}
    assert set(left) == set("abcd") and all(0 <= q <= 70 for q in left.values())
    assert {w[2] for w in want} == {"StockReserved", "StockOutOfStock"}


def state_rows(query):
    return sum(s.numRowsTotal for s in query.lastProgress.stateOperators)


def test_unpaid_orders_leave_the_state(spark, tmp_path):
    start = datetime(2024, 1, 1)
    created = [(o, [("s", o)], start + timedelta(minutes=o), o % 2) for o in range(10)]
    created.append((99, [], start + timedelta(days=9), 2))
    paid = [(o, start + timedelta(minutes=o + 1), 0, o, (o + 1) % 2) for o in range(0, 10, 3)]
    paid.append((98, start + timedelta(days=9), 0, 98, 2))
    schema = "order_id BIGINT, items ARRAY<STRUCT<sku: STRING, quantity: BIGINT>>, created_at TIMESTAMP, b INT"
    lefts = inputs.arriving(spark.createDataFrame(created, schema), F.col("b"), 3, f"{tmp_path}/c")
    rights = inputs.arriving(
        spark.createDataFrame(paid, "order_id BIGINT, paid_at TIMESTAMP, partition INT, offset BIGINT, b INT"),
        F.col("b"), 3, f"{tmp_path}/p",
    )
    held = []
    for left, right in zip(lefts, rights):
        query = sinks.append_table(
            paid_items(left, right, within_seconds=600, watermark="1 hour"), f"{tmp_path}/t", f"{tmp_path}/ck", every=None
        )
        query.awaitTermination()
        held.append(state_rows(query))
    got = spark.read.parquet(f"{tmp_path}/t").collect()
    assert sorted((r.order_id, r["items"][0].quantity) for r in got) == [(o, o) for o in range(0, 10, 3)]
    assert held[1] >= 10 and held[2] <= 5  # the two last rows remain, each in up to two slots


def test_finished_sagas_leave_the_state(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    start = datetime(2024, 1, 1)
    rows = [(1, 0, 0, "OrderCreated", start, None, None, 0), (2, 0, 0, "OrderCreated", start, None, None, 0)]
    rows += [(2, 0, 1, "PaymentFailed", start + timedelta(minutes=1), None, None, 0)]
    # Paid after the cancellation by silence: the payment is given back.
    rows += [(1, 0, 1, "PaymentCompleted", start + timedelta(hours=2), "t", None, 1)]
    rows += [(9, 0, 0, "OrderShipped", start + timedelta(hours=2), None, None, 1)]
    rows += [(9, 0, 1, "OrderShipped", start + timedelta(days=5), None, None, 2)]
    schema = (
        "order_id BIGINT, partition INT, offset BIGINT, event_type STRING, occurred_at TIMESTAMP, "
        "transaction_id STRING, reservation_id STRING, b INT"
    )
    frame = spark.createDataFrame(rows, schema)
    for stream in inputs.arriving(frame, F.col("b"), 3, f"{tmp_path}/e"):
        query = sinks.append_table(
            saga_commands(stream, timeout_seconds=600, keep_seconds=3600), f"{tmp_path}/t", f"{tmp_path}/ck", every=None
        )
        query.awaitTermination()
    got = sorted((r.order_id, r.command, r.reason) for r in spark.read.parquet(f"{tmp_path}/t").collect())
    assert got == [
        (1, "CancelOrder", "timed_out"), (1, "ChargePayment", None), (1, "RefundPayment", None),
        (2, "CancelOrder", "payment_failed"), (2, "ChargePayment", None),
    ]
    keys = spark.read.format("statestore").option("stateVarName", "saga").load(f"{tmp_path}/ck")
    assert {r.key.order_id for r in keys.collect()} == {9}


def test_finished_orders_leave_the_state_of_snapshots(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    start = datetime(2024, 1, 1)

    def event(order, offset, kind, hours, batch):
        row = (order, 0, offset, offset + 1, kind, start + timedelta(hours=hours), "c", 1.0, "EUR", "t", "r", "n", "x")
        return (*row, batch)

    rows = [event(1, i, k, 0, 0) for i, k in enumerate(KINDS)]  # cancelled by its fifth event
    rows += [event(2, i, k, 0, 0) for i, k in enumerate(KINDS[:4])] + [event(2, 4, "OrderShipped", 1, 1)]
    rows += [event(3, 0, "OrderCreated", 200, 2)]
    frame = spark.createDataFrame(rows, LOG + ", b INT")
    for stream in inputs.arriving(frame, F.col("b"), 3, f"{tmp_path}/e"):
        query = sinks.append_table(
            snapshot_stream(stream, keep_seconds=3600), f"{tmp_path}/t", f"{tmp_path}/ck", every=None
        )
        query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/t").collect()
    assert sorted((r.order_id, r.version, r.status) for r in got) == [(1, 5, "CANCELLED"), (2, 5, "SHIPPED")]
    left = spark.read.format("statestore").option("stateVarName", "order").load(f"{tmp_path}/ck").collect()
    assert {r.key.order_id for r in left} == {2, 3}  # shipped and new ones still have events to come


def test_waits_until_any_query_ends(spark, tmp_path):
    spark.streams.resetTerminated()
    endless = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    lasting = sinks.append_table(endless, f"{tmp_path}/a", f"{tmp_path}/ca", every="1 second")
    broken = endless.select(F.raise_error(F.lit("broken")).alias("x"))
    failing = sinks.append_table(broken, f"{tmp_path}/b", f"{tmp_path}/cb", every="1 second")
    try:
        with pytest.raises(Exception, match="broken"):
            sinks.await_any(spark, 60)
        assert lasting.isActive and not failing.isActive
    finally:
        lasting.stop()
        spark.streams.resetTerminated()


def test_lag_by_the_last_known_end(spark):
    at = [datetime(2024, 1, 1, 0, m) for m in range(10)]
    ends = spark.createDataFrame(
        [("t", 0, at[2], 10), ("t", 0, at[5], 30), ("u", 0, at[1], 7)],
        "topic STRING, partition INT, ts TIMESTAMP, end_offset BIGINT",
    )
    committed = spark.createDataFrame(
        [("g", "t", 0, at[1], 3), ("g", "t", 0, at[2], 4), ("h", "t", 0, at[4], 12), ("g", "t", 0, at[9], 25), ("g", "v", 0, at[9], 1)],
        "consumergroup STRING, topic STRING, partition INT, ts TIMESTAMP, committed_offset BIGINT",
    )
    got = {(r.consumergroup, r.topic, r.committed_offset): r.lag for r in metrics.lag_over_time(ends, committed).collect()}
    assert got == {("g", "t", 3): None, ("g", "t", 4): 6, ("h", "t", 12): 0, ("g", "t", 25): 5, ("g", "v", 1): None}
