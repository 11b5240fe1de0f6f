"""Paid items with the waiting rows in tables: the rows of the stream-stream join."""

import glob
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from millrace.plans import inputs
from millrace.runtime import ROCKSDB_PROVIDER, shared_folder
from millrace.streaming import paid, sinks
from millrace.streaming.joins import paid_items

CREATED = "order_id BIGINT, items ARRAY<STRUCT<sku: STRING, quantity: BIGINT>>, created_at TIMESTAMP, b INT"
PAID = "order_id BIGINT, paid_at TIMESTAMP, partition INT, offset BIGINT, b INT"
BATCHES = 6


def rows():
    """Orders of six hours that arrive up to three batches late, some paid too late or twice."""
    rng, start = random.Random(8), datetime(2024, 1, 1)
    created, payments = [], []
    for o in range(300):
        batch = o * BATCHES // 300
        late = rng.choice([0, 0, 0, 1, 3])
        made = start + timedelta(minutes=o * 1.2)
        created.append((o or None, [("s", o)], None if o == 7 else made, min(batch + late, BATCHES - 1)))
        first = made + timedelta(seconds=rng.choice([0, 60, 599, 600, 601, -1]))
        for again in range(rng.choice([0, 1, 1, 2, 3])):
            at = first + timedelta(seconds=again * rng.choice([0, 500, 3600]))
            payments.append((o or None, at, 0, o, min(batch + rng.choice([0, 0, 1, 2]) * (again + 1), BATCHES - 1)))
    # Of the payments of one order and batch the stream keeps any, so there is one.
    return created, list({(p[0], p[4]): p for p in payments}.values())


@pytest.mark.parametrize("watermark, compact_every", [("30 minutes", None), ("90 minutes", 2), ("1 day", 1)])
def test_tables_give_the_rows_of_the_join(spark, tmp_path, watermark, compact_every):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    created, payments = (spark.createDataFrame(r, s) for r, s in zip(rows(), (CREATED, PAID)))
    lefts = inputs.arriving(created, F.col("b"), BATCHES, f"{tmp_path}/c")
    rights = inputs.arriving(payments, F.col("b"), BATCHES, f"{tmp_path}/p")
    for left, right in zip(lefts, rights):
        joined = paid_items(left, right, within_seconds=600, watermark=watermark)
        sinks.append_table(joined, f"{tmp_path}/t", f"{tmp_path}/ck", every=None).awaitTermination()
        paid.paid_items_stream(
            left, right, f"{tmp_path}/home", f"{tmp_path}/ck2", within_seconds=600, watermark=watermark,
            every=None, compact_every=compact_every,
        ).awaitTermination()
    columns = ["order_id", "paid_at", "partition", "offset", "items"]
    got = sorted(map(str, paid.read_paid_items(spark, f"{tmp_path}/home").select(columns).collect()))
    assert got == sorted(map(str, spark.read.parquet(f"{tmp_path}/t").select(columns).collect()))
    assert len(got) > 20


def test_a_batch_that_runs_again_replaces_its_rows(spark, tmp_path):
    home, hour = str(tmp_path), 3_600_000_000
    kind = "order_id BIGINT, at TIMESTAMP, items ARRAY<BIGINT>, partition INT, offset BIGINT, paid BOOLEAN"
    start = datetime(2024, 1, 1)

    def apply(batch_id, *batch):
        paid.apply_batch(home, spark.createDataFrame(batch, kind), batch_id, hour, hour, fold=batch_id == 1)

    apply(0, (1, start, [1], None, None, False), (2, start, [2], None, None, False))
    one = (1, start + timedelta(minutes=5), None, 0, 4, True)
    apply(1, one)
    apply(1, one)
    apply(2, (1, start + timedelta(minutes=9), None, 0, 5, True), (2, start + timedelta(minutes=9), None, 0, 6, True))
    # All are ahead by hours: what waits is behind the watermark.
    apply(3, (9, start + timedelta(hours=9), [9], None, None, False), (9, start + timedelta(hours=9), None, 0, 7, True))
    apply(4, (2, start + timedelta(minutes=9), None, 0, 8, True))
    got = [(r.order_id, r.offset, r["items"]) for r in paid.read_paid_items(spark, home).collect()]
    assert sorted(got) == [(1, 4, [1]), (2, 6, [2]), (9, 7, [9])]
    assert spark.read.parquet(f"{home}/arrived/base=1").count() == 2


def test_the_query_needs_no_entry_of_the_state_for_each_row(spark):
    before = set(glob.glob(f"{shared_folder(spark)}/paid-*"))
    query = entry_points.queries()["paid_items_streamed"](spark, "/root/testdata/sf0.001")
    assert query.count() > 1000
    (work,) = set(glob.glob(f"{shared_folder(spark)}/paid-*")) - before
    assert glob.glob(f"{work}/checkpoint/*") and not glob.glob(f"{work}/checkpoint/state")
