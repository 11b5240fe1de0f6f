from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from millrace.functions import cdc, relabel, shaping
from millrace.operators import eventlog, metrics as M, saga
from millrace.operators.stock import reserve
from millrace.schemas import CDC_SOURCE, MONEY, ORDER_EVENTS
from millrace.sources import generators
from millrace.sources.tables import file_inventory, peek_newest, read_partitioned
from millrace.streaming.sinks import write_time_partitioned

T0 = datetime(2024, 5, 1, tzinfo=timezone.utc)


def order_event(i, order, kind, version, **fields):
    row = dict.fromkeys(ORDER_EVENTS.fieldNames())
    row |= {"event_id": f"e{i}", "order_id": order, "occurred_at": T0 + timedelta(seconds=i),
            "version": version, "event_type": kind, "partition": 0, "offset": i, **fields}
    return row


def log_of(spark, rows):
    return spark.createDataFrame([tuple(r.values()) for r in rows], ORDER_EVENTS)


def place(spark, sku, quantity, price):
    text = (
        f'{{"command_type":"PlaceOrder","order_id":"o1","customer_id":"c1",'
        f'"items":[{{"sku":"{sku}","quantity":{quantity},"unit_price":{price}}}]}}'
    )
    messages = spark.createDataFrame([(text,)], "value STRING")
    created = saga.orders_created(saga.accepted_commands(saga.parse_commands(messages)), F.lit(T0))
    return created.withColumns({"partition": F.lit(0), "offset": F.lit(1).cast("bigint")})


@pytest.mark.parametrize("price, kind", [(1000.0, "PaymentCompleted"), (1000.01, "PaymentFailed")])
def test_payment_limit(spark, price, kind):
    row = saga.payment_decisions(place(spark, "SKU-001", 1, price)).first()
    assert (row["event_type"], row["version"]) == (kind, 2)
    assert row["reason"] == (None if kind == "PaymentCompleted" else "amount 1000.01 exceeds 1000.0")


@pytest.mark.parametrize("sku, kind", [("SKU-001", "StockReserved"), ("SKU-003", "StockOutOfStock")])
def test_saga_of_one_order(spark, sku, kind):
    created = place(spark, sku, 1, 50.0)
    paid = saga.payment_decisions(created).first()
    assert paid["event_type"] == "PaymentCompleted" and float(paid["amount"]) == 50.0
    demands = created.select("order_id", F.lit(2).cast("bigint").alias("offset"), F.posexplode("items").alias("line_no", "i")).select(
        "order_id", "offset", "line_no", "i.sku", "i.quantity"
    )
    stock = spark.createDataFrame(
        [("SKU-001", 10), ("SKU-002", 5), ("SKU-003", 0)], "sku STRING, quantity BIGINT"
    )
    outcome = reserve(demands, stock)
    assert outcome.first()["event_type"] == kind
    events = outcome.select("order_id", F.lit(3).alias("version"), "event_type", F.lit("e3").alias("event_id"),
                            F.lit(T0).alias("occurred_at"))
    cancelled = saga.cancellations(events).collect()
    shipped = saga.shipments(events).collect()
    if kind == "StockReserved":
        assert not cancelled
        assert [(r["event_type"], r["version"]) for r in shipped] == [("OrderShipped", 4), ("OrderDelivered", 5)]
        assert shipped[1]["delivered_at"] - shipped[0]["occurred_at"] == timedelta(seconds=2)
    else:
        assert [(r["reason"], r["version"]) for r in cancelled] == [("out_of_stock", 4)] and not shipped


def test_fold_time_travel_and_duplicates(spark):
    rows = [
        order_event(1, "a", "OrderCreated", 1, customer_id="c", total=9.0, currency="USD"),
        order_event(2, "a", "PaymentCompleted", 2, transaction_id="t"),
        order_event(3, "a", "StockReserved", 3, reservation_id="r"),
        order_event(4, "a", "OrderCancelled", 4, reason="late"),
        order_event(5, "a", "StockReleased", 5, reservation_id="released-a"),
        order_event(6, "b", "PaymentFailed", 1, reason="no"),
    ]
    log = log_of(spark, rows)
    states = {r["order_id"]: r for r in eventlog.fold(log).collect()}
    a = states["a"]
    assert (a["status"], a["version"], a["currency"], a["reservation_id"], a["cancel_reason"]) == (
        "CANCELLED", 5, "USD", "r", "late",
    )
    b = states["b"]
    assert (b["status"], b["customer_id"], b["total"], b["currency"], b["cancel_reason"]) == (
        "CREATED", "", 0.0, "EUR", None,
    )
    assert eventlog.at_version(log, 2).filter("order_id = 'a'").first()["status"] == "PAID"
    twice = log.unionByName(log)
    assert eventlog.replay_order(twice, "a").collect() == [a]
    snaps = eventlog.snapshots(log, every=2, offsets_per_chunk=2)
    assert [(r["version"], r["status"]) for r in snaps.orderBy("version").collect()] == [
        (2, "PAID"), (4, "CANCELLED"),
    ]
    tail = log.filter("offset > 4")
    rebuilt = {r["order_id"]: r for r in eventlog.bootstrap(snaps, tail).collect()}
    assert rebuilt["a"] == a
    kinds = {(r["event_type"], r["reservation_id"]) for r in saga.compensations(log, refunds=True).collect()}
    assert kinds == {("StockReleased", "released-a"), ("PaymentRefunded", None)}
    assert [r["order_id"] for r in eventlog.version_gaps(log.filter("offset <> 2")).collect()] == ["a"]


def samples(spark, values, step=15, metric="m", labels={"instance": "a"}):
    rows = [(T0 + timedelta(seconds=step * i), metric, labels, float(v)) for i, v in values]
    return spark.createDataFrame(rows, "ts TIMESTAMP, metric STRING, labels MAP<STRING,STRING>, value DOUBLE")


def states(df, hold, **options):
    rows = M.alert_states(df, F.col("value") > 0, hold, **options).orderBy("ts").collect()
    return [r["state"][0] for r in rows]


def test_alert_holds(spark):
    up = lambda *v: list(enumerate(v))
    # Exactly the duration fires; one good sample starts the wait again.
    assert states(samples(spark, up(0, 1, 1, 1, 0, 1, 1)), 30, chunk_seconds=30) == list("ippfipp")
    # A missing sample breaks the run.
    gap = [(0, 1), (1, 1), (2, 1), (6, 1), (7, 1), (8, 1)]
    assert states(samples(spark, gap), 30) == list("ppfppf")


def test_counter_restart_and_range_edges(spark):
    df = samples(spark, [(0, 10), (1, 15), (2, 4), (3, 9), (4, 9)])
    grown = M.counter_deltas(df, chunk_seconds=20).orderBy("ts").collect()
    assert [r["delta"] for r in grown] == [None, 5.0, 4.0, 5.0, 0.0]
    rows = M.counter_increase(df, 30, ["instance"]).orderBy("ts").collect()
    # (0 s, 30 s] holds the samples at 15 and 30 seconds, (30 s, 60 s] the next two.
    assert [r["increase"] for r in rows] == [9.0, 5.0]
    assert [r["rate"] for r in M.counter_rate(df, 30, ["instance"]).orderBy("ts").collect()] == [0.3, 5 / 30]


def rule(name):
    return next(r for r in M.ALERT_RULES if r.name == name)


def fired(df, name):
    return {r["state"] for r in M.evaluate_rule(df, rule(name)).collect()}


def test_rules_see_the_latest_sample_of_each_series(spark):
    brokers = {"job": "kafka-brokers", "instance": "a"}
    down = samples(spark, [(i, 0) for i in range(8)], metric="up", labels=brokers)
    assert "firing" in fired(down, "KafkaBrokerDown")
    other = samples(spark, [(i, 0) for i in range(8)], metric="up", labels={"job": "kafka-connect"})
    assert fired(other, "KafkaBrokerDown") == set()
    assert M.instances_up(other, labels=(("job", "kafka-brokers"),)).first()["n_up"] == 0

    # Three brokers report seconds apart, exactly one of them leads.
    name = rule("KafkaActiveControllerCountInvalid").metric
    parts = [
        samples(spark, [(i + k / 5, k == 1) for i in range(30)], metric=name, labels={"instance": str(k)})
        for k in range(3)
    ]
    three = parts[0].union(parts[1]).union(parts[2])
    late = T0 + timedelta(seconds=30)  # by then all have reported
    found = M.evaluate_rule(three, rule("KafkaActiveControllerCountInvalid")).filter(F.col("ts") > F.lit(late))
    # The samples end after 435 s; the last grid times still see all of them, then none.
    assert {r["state"] for r in found.filter(F.col("ts") <= F.lit(T0 + timedelta(seconds=700))).collect()} == {"inactive"}


def test_a_series_that_stops_leaves_the_grid(spark):
    short = samples(spark, [(0, 7), (1, 8)], step=40)
    grid = M.on_grid(short, 30, 120).withColumn("at", F.unix_seconds("ts")).orderBy("ts")
    assert [(r["at"] - T0.timestamp(), r["value"]) for r in grid.collect()] == [
        (0, 7), (30, 7), (60, 8), (90, 8), (120, 8), (150, 8),
    ]


def test_bands_and_thresholds(spark):
    lags = spark.createDataFrame([(99,), (100,), (1000,), (10000,)], "lag INT")
    assert [r[0] for r in lags.select(M.lag_severity(F.col("lag"))).collect()] == [
        "normal", "elevated", "high", "critical",
    ]
    controller = M.SUM_THRESHOLDS[0][0]
    rows = [(controller, {"i": str(k)}, float(k == 0)) for k in range(3)]
    rows += [(M.HEAP_METRIC, {"i": "0"}, 81.0), ("jvm_gc_collection_time_ms", {"i": "0"}, 500.0)]
    rows += [("jvm_gc_collection_time_ms", {"i": "1"}, 501.0), ("kafka_consumergroup_lag", {"g": "x"}, 10000.0)]
    gauges = spark.createDataFrame(rows, "metric STRING, labels MAP<STRING,STRING>, value DOUBLE")
    got = {(r["metric"], tuple(r["labels"].items())): r["breached"] for r in M.breaches(gauges, heap_limit_bytes=100).collect()}
    assert got == {
        (controller, ()): False,
        (M.HEAP_METRIC, (("i", "0"),)): True,
        ("jvm_gc_collection_time_ms", (("i", "0"),)): False,
        ("jvm_gc_collection_time_ms", (("i", "1"),)): True,
        ("kafka_consumergroup_lag", (("g", "x"),)): False,
    }


def test_relabel_first_rule_wins(spark):
    names = ["java.lang<type=GarbageCollector, name=G1 Young><>CollectionTime",
             "kafka.controller<type=KafkaController, name=ActiveControllerCount><>Value", "other"]
    df = spark.createDataFrame([(n,) for n in names], "raw_name STRING")
    rows = {r["raw_name"]: r for r in relabel.relabel(df).collect()}
    assert (rows[names[0]]["metric"], rows[names[0]]["labels"]) == (
        "jvm_gc_collection_time_ms", {"gc": "G1 Young"},
    )
    assert rows[names[1]]["metric"] == "kafka_controller_kafkacontroller_activecontrollercount"
    assert rows["other"]["metric"] is None


def test_unwrap_and_typed_projection(spark):
    image = "STRUCT<order_id: INT, status: STRING>"
    df = spark.createDataFrame(
        [(None, (1, "new"), "c"), ((1, "new"), (1, "paid"), "u"), ((1, "paid"), None, "d"), (None, None, "d")],
        f"before {image}, after {image}, op STRING",
    )
    source = F.lit(None).cast(CDC_SOURCE)
    rows = cdc.unwrap(df.withColumns({"source": source, "ts_ms": F.lit(1)}), F.lit("orders")).collect()
    assert [(r["status"], r["__op"], r["__deleted"]) for r in rows] == [
        ("new", "c", "false"), ("paid", "u", "false"), ("paid", "d", "true"),
    ]
    from pyspark.errors import AnalysisException
    from millrace.schemas import ORDER_MODEL

    wrong = spark.createDataFrame([("x",)], "created_at STRING").select(F.array("created_at").alias("created_at"))
    with pytest.raises(AnalysisException):
        shaping.typed(wrong, ORDER_MODEL).schema


def test_items_total_rounds_once(spark):
    df = spark.createDataFrame([([(3, 0.335), (1, 0.01)],)], "items ARRAY<STRUCT<quantity: INT, unit_price: DOUBLE>>")
    assert df.select(shaping.items_total(F.col("items"))).first()[0] == __import__("decimal").Decimal("1.02")


def test_generated_orders(spark):
    rows = generators.orders(spark, 7, now=T0).orderBy("id").collect()
    assert (rows[6]["customer_id"], rows[6]["total"], rows[6]["currency"]) == ("cust-001", 31.0, "EUR")
    plain = generators.orders(spark, 7, "plain", now=T0).orderBy("id").collect()
    assert (plain[6]["customer_id"], round(plain[6]["total"], 2)) == ("customer-1", 59.94)
    paid = generators.payments(generators.orders(spark, 3, now=T0)).collect()
    assert {r["method"] for r in paid} <= {"card", "paypal", "transfer"} and len(paid) == 3
    assert generators.order_stream(spark, 5).isStreaming


def test_partition_folders_and_inventory(spark, tmp_path):
    rows = [("orders", T0 + timedelta(hours=h), h) for h in range(30)]
    df = spark.createDataFrame(rows, "topic STRING, kafka_ts TIMESTAMP, v INT")
    write_time_partitioned(df, str(tmp_path / "t"))
    assert (tmp_path / "t/topic=orders/year=2024/month=05/day=01/hour=07").is_dir()
    pruned = read_partitioned(spark, str(tmp_path / "t"), day=2, hour=3)
    assert [r["v"] for r in pruned.collect()] == [27]
    assert "PartitionFilters: [isnotnull" in pruned._jdf.queryExecution().toString()
    files = file_inventory(spark, str(tmp_path / "t"))
    assert files.agg(F.sum("n_rows")).first()[0] == 30
    assert peek_newest(spark, str(tmp_path / "t")).count() == 1


def test_busy_hours_are_cut_into_files(spark, tmp_path):
    """One hour with most rows, others with few, and rows without a time."""
    rows = [(i, "t", datetime(2024, 1, 1, 5 if i < 900 else i % 24)) for i in range(1000)] + [(2000, "t", None)]
    df = spark.createDataFrame(rows, "offset BIGINT, topic STRING, kafka_ts TIMESTAMP")
    write_time_partitioned(df, str(tmp_path / "t"), rows_per_file=100)
    files = list((tmp_path / "t").rglob("*.parquet"))
    busy = [f for f in files if "hour=05" in str(f)]
    assert 5 <= len(busy) <= 10 and len(files) <= 24 + len(busy)
    assert sorted(r.offset for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [r[0] for r in rows]
