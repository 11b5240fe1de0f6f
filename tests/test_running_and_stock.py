import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.operators.running import Running, numbered, offset_chunk, running
from millrace.operators import stock as stock_module
from millrace.operators.components import components
from millrace.operators.stock import demands_of_paid_orders, reserve
from millrace.plans.event_queries import single_sku_demands


def test_running_equals_brute_force_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        key = "hot" if rng.random() < 0.5 else f"k{rng.randrange(9)}"
        rows.append((i, key, rng.randrange(10), rng.choice([None, "a", "b", "c"])))
    df = spark.createDataFrame(rows, "i BIGINT, k STRING, v BIGINT, s STRING").repartition(7)
    spec = Running(
        sums={"total": F.col("v")}, lasts={"last": F.col("s")}, lags={"before": F.col("s")}
    )
    got = {
        r["i"]: (r["total"], r["last"], r["before"])
        for r in running(df, ["k"], ["i"], offset_chunk(F.col("i"), 37), spec).collect()
    }
    totals, lasts, before, expected = {}, {}, {}, {}
    for i, key, v, s in rows:
        totals[key] = totals.get(key, 0) + v
        lasts[key] = s if s is not None else lasts.get(key)
        expected[i] = (totals[key], lasts[key], before.get(key))
        before[key] = s
    assert got == expected


def test_running_shuffles_the_detail_once(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("i"))
    plan = numbered(df, ["k"], ["i"], offset_chunk(F.col("i"), 100))._jdf.queryExecution()
    text = plan.optimizedPlan().toString()
    assert text.count("Join") == 1
    windows = [l for l in text.splitlines() if "Window" in l]
    assert any("_chunk" in l for l in windows)


def brute_force(orders, stock, releases):
    """orders: {order: (place, {sku: (qty, line_no)})}; releases: [(order, place)]"""
    left, held, result = dict(stock), {}, {}
    moves = [(*place, o, 1) for o, (place, _) in orders.items()]
    moves += [(*place, o, 0) for o, place in releases]
    for *place, o, asks in sorted(moves):
        lines = orders[o][1]
        if not asks:
            if held.pop(o, False):
                for sku, (q, _) in lines.items():
                    left[sku] += q
            continue
        lacking = [(n, sku) for sku, (q, n) in lines.items() if left.get(sku, 0) < q]
        if lacking:
            result[o] = ("StockOutOfStock", min(lacking)[1])
        else:
            held[o] = True
            for sku, (q, _) in lines.items():
                left[sku] -= q
            result[o] = ("StockReserved", None)
        assert all(q >= 0 for q in left.values())
    return result


@pytest.mark.parametrize("seed", [3, 4])
def test_reserve_equals_brute_force(spark, seed):
    """Tied times and offsets on three log partitions, early, late and repeated releases."""
    rng = random.Random(seed)
    orders, releases = {}, []
    for o in range(90):
        skus = rng.sample(["hot", "b", "c", "d", "none"], rng.choice([1, 1, 2, 3]))
        if rng.random() < 0.4 and "hot" not in skus:
            skus.append("hot")
        place = (rng.randrange(60), rng.randrange(3), rng.randrange(4))
        orders[o] = (place, {s: (rng.randint(1, 6), n) for n, s in enumerate(skus)})
        for _ in range(rng.choice([0, 0, 0, 1, 2])):
            later = (place[0] + rng.choice([-9, 0, 1, 15]), rng.randrange(3), rng.randrange(4))
            releases.append((o, later))
    stock = {"hot": 60, "b": 20, "c": 12, "d": 50}
    demands = spark.createDataFrame(
        [(o, *place, n, s, q) for o, (place, lines) in orders.items() for s, (q, n) in lines.items()],
        "order_id BIGINT, at BIGINT, partition INT, offset BIGINT, line_no INT, sku STRING, quantity BIGINT",
    )
    got = reserve(
        demands,
        spark.createDataFrame(list(stock.items()), "sku STRING, quantity BIGINT"),
        spark.createDataFrame(
            [(o, *place) for o, place in releases],
            "order_id BIGINT, at BIGINT, partition INT, offset BIGINT",
        ),
        at_per_chunk=7,
    ).collect()
    assert {r["order_id"]: (r["event_type"], r["missing_sku"]) for r in got} == brute_force(
        orders, stock, releases
    )


def test_no_order_takes_what_another_holds(spark):
    demands = spark.createDataFrame(
        [(o, o % 2, 7, 0, "S", 3) for o in range(6)],
        "order_id BIGINT, partition INT, offset BIGINT, line_no INT, sku STRING, quantity BIGINT",
    )
    stock = spark.createDataFrame([("S", 4)], "sku STRING, quantity BIGINT")
    got = reserve(demands, stock).collect()
    assert sorted(r["event_type"] for r in got) == ["StockOutOfStock"] * 5 + ["StockReserved"]
    # A release before the request gives nothing back.
    early = spark.createDataFrame([(0, 0, 1)], "order_id BIGINT, partition INT, offset BIGINT")
    got = reserve(demands, stock, early).collect()
    assert [r["order_id"] for r in got if r["event_type"] == "StockReserved"] == [0]


def test_two_lines_of_one_sku_ask_for_their_sum(spark):
    events = spark.createDataFrame(
        [
            ("o1", "OrderCreated", 0, 0, [("S", 3), ("S", 3)]),
            ("o1", "PaymentCompleted", 0, 2, None),
            ("o2", "OrderCreated", 0, 1, [("S", 2)]),
            ("o2", "PaymentCompleted", 0, 3, None),
            ("o3", "OrderCreated", 0, 4, [("S", 1)]),
        ],
        "order_id STRING, event_type STRING, partition INT, offset BIGINT, "
        "items ARRAY<STRUCT<sku: STRING, quantity: INT>>",
    )
    stock = spark.createDataFrame([("S", 5)], "sku STRING, quantity BIGINT")
    got = reserve(demands_of_paid_orders(events), stock).collect()
    assert {r["order_id"]: (r["event_type"], r["missing_sku"]) for r in got} == {
        "o1": ("StockOutOfStock", "S"), "o2": ("StockReserved", None),
    }


def scans_of(df):
    """Scans, and exchanges used again, in the plan that ran."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return plan.count("FileScan"), plan.count("ReusedExchange")


def test_running_scans_its_input_once(spark, tmp_path):
    rows = [(k, i, float(i), {"a": "b"}) for k in range(3) for i in range(500)]
    spark.createDataFrame(rows, "k int, i int, v double, m map<string,string>").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    spec = Running(sums={"s": F.col("v")}, lasts={"l": F.col("v")}, lags={"g": F.col("m")})
    out = running(df, ["k"], ["i"], offset_chunk(F.col("i"), 50), spec)
    assert scans_of(out.select("k", "s")) == (1, 1)
    got = sorted((r.k, r.i, r.s, r.l, r.g) for r in out.collect())
    assert got == [
        (k, i, sum(range(i + 1)), float(i), {"a": "b"} if i else None) for k in range(3) for i in range(500)
    ]


@pytest.mark.parametrize("name, most", [("counter_rate", 2), ("order_snapshots", 1), ("bootstrapped_states", 2)])
def test_registered_queries_scan_their_table_once_or_twice(spark, name, most):
    import __spark_entry__ as entry_points

    scans, reused = scans_of(entry_points.queries()[name](spark, "/root/testdata/sf0.001"))
    assert scans <= most and reused


@pytest.mark.parametrize("rows", [0, 40])
def test_groups_in_order_and_in_rounds_agree(spark, monkeypatch, rows):
    """No, and some, groups small enough for one pass."""
    monkeypatch.setattr(stock_module, "GROUP_ROWS", rows)
    test_reserve_equals_brute_force(spark, 5)
    test_two_lines_of_one_sku_ask_for_their_sum(spark)


def test_components_are_named_by_their_smallest_node(spark):
    links = [(i, i + 1) for i in range(30)] + [(50, 40), (40, 60), (7, 7)]
    got = components(spark.createDataFrame(links, "a int, b int")).collect()
    assert {r.node: r.component for r in got} == {i: 0 for i in range(31)} | {i: 40 for i in (40, 50, 60)}
    assert components(spark.createDataFrame([], "a int, b int")).count() == 0


def test_a_group_of_many_entries_needs_no_rounds(spark, monkeypatch):
    def rounds(*_):
        raise AssertionError("settled in rounds")

    monkeypatch.setattr(stock_module, "_in_rounds", rounds)
    order = F.col("id").alias("order_id")
    asked = spark.range(150_000).select(order, F.col("id").alias("offset"), F.lit(0).alias("line_no"), F.lit("a").alias("sku"), F.lit(1).alias("quantity"))
    stock = spark.createDataFrame([("a", 149_000)], "sku STRING, quantity BIGINT")
    found = stock_module.reserve(asked, stock).groupBy("event_type").count().collect()
    assert {r.event_type: r["count"] for r in found} == {"StockReserved": 149_000, "StockOutOfStock": 1_000}


def test_entries_of_one_sku_orders_are_shuffled_once_and_joined_with_nothing(spark, tmp_path):
    """A SKU that is not in stock has none; the stock of a SKU may come in parts; of
    several lines of one SKU the sum counts."""
    lines = [(o, o, n, o % 4, 2) for o in range(40) for n in range(2)]
    demands = spark.createDataFrame(lines, "order_id INT, offset BIGINT, line_no INT, sku INT, quantity INT")
    demands.write.parquet(f"{tmp_path}/demands")
    demands = spark.read.parquet(f"{tmp_path}/demands")
    stock = spark.createDataFrame([(0, 10), (0, 6), (1, 7), (2, None), (9, 5)], "sku BIGINT, quantity INT")
    got = stock_module.reserve(demands, stock, store=False)
    taken = {0: 4, 1: 1, 2: 0, 3: 0}
    want = {o: None if o // 4 < taken[o % 4] else o % 4 for o in range(40)}
    assert {r.order_id: r.missing_sku for r in got.collect()} == want
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_places_of_lines_are_their_ranks(spark):
    rng, start = random.Random(2), datetime(2024, 1, 1)
    rows = [
        (rng.choice([5, 5, 5, rng.randrange(300)]), rng.randrange(9), rng.randrange(3), start, 1.0 * i, rng.randrange(5), 2.0)
        for i in range(3000)
    ]
    names = "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_shipdate TIMESTAMP, l_extendedprice DOUBLE, l_suppkey BIGINT, l_quantity DOUBLE"
    missing = [(None, 1, 1, start, 1.0, 1, 1.0), (1, None, 1, start, 1.0, 1, 1.0)]
    found = single_sku_demands(spark.createDataFrame(rows + missing, names))
    got = [(r.order_id, r.sku) for r in found.select("order_id", "sku").collect()]
    assert sorted(got) == [(i + 1, r[1]) for i, r in enumerate(sorted(rows))]
    # The lines themselves are shuffled, by ranges, before they are stored: no more after.
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning" not in plan
