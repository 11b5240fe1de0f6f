"""Many keys in one entry of the state: the same rows from far fewer entries."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.plans import inputs
from millrace.runtime import ROCKSDB_PROVIDER
from millrace.streaming import sinks
from millrace.streaming.dashboard import dashboard_changes
from millrace.streaming.dedup import first_with_ttl
from millrace.streaming.orchestrator import saga_commands
from millrace.streaming.snapshots import snapshot_stream

LOG = (
    "order_id BIGINT, partition INT, offset BIGINT, version INT, event_type STRING, occurred_at TIMESTAMP, "
    "customer_id STRING, total DOUBLE, currency STRING, transaction_id STRING, reservation_id STRING, "
    "tracking_number STRING, reason STRING, b INT"
)
KINDS = ("OrderCreated", "PaymentCompleted", "StockReserved", "OrderShipped", "OrderCancelled")


def rows():
    """Sixty orders, some silent or delivered again, and one that lets all timers run out."""
    start = datetime(2024, 1, 1)
    for o in range(60):
        for i, kind in enumerate(KINDS[: o % 6]):
            row = (o if o else None, 0, i, i + 1, kind, start + timedelta(hours=i, seconds=o), f"c{i}", 1.5 * o, "EUR")
            row += (f"t{o}" if i == 1 else None, f"r{o}" if i == 2 else None, None, None)
            yield (*row, i // 2)
            if o % 7 == 0 and i == 0:
                yield (*row, 1)
    yield (99, 0, 0, 1, "OrderShipped", start + timedelta(days=30), *[None] * 7, 3)


OPERATORS = {
    "saga": lambda s, n: saga_commands(s, timeout_seconds=5400, keep_seconds=3 * 3600, buckets=n),
    "cell": lambda s, n: dashboard_changes(s, buckets=n),
    "order": lambda s, n: snapshot_stream(s, every=2, buckets=n),
    "order, expiring": lambda s, n: snapshot_stream(s, every=2, keep_seconds=3600, buckets=n),
    "seen": lambda s, n: first_with_ttl(s.drop("b"), ["order_id", "total", "occurred_at"], 3_600_000, buckets=n),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_buckets_change_no_row(spark, tmp_path, name):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", str(name != "seen"))
    frame, got, entries = spark.createDataFrame(list(rows()), LOG), {}, {}
    try:
        for n in (None, 3):
            home = f"{tmp_path}/{n}"
            for stream in inputs.arriving(frame, F.floor(F.col("b") / 2), 2, f"{home}/in"):
                out = OPERATORS[name](stream, n)
                sinks.append_table(out, f"{home}/t", f"{home}/ck", every=None).awaitTermination()
            got[n] = sorted(map(str, spark.read.parquet(f"{home}/t").collect()))
            reader = spark.read.format("statestore").option("stateVarName", name.split(",")[0])
            entries[n] = reader.load(f"{home}/ck").count()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert got[3] == got[None] and got[3]
    assert entries[3] <= 3
    assert name == "saga" or entries[None] > 10
