"""Queries over the order event log and the saga."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import eventlog, saga
from millrace.operators.dedup import once_per_event
from millrace.operators.stock import RESERVED, demands_of_paid_orders, reserve
from millrace.plans import inputs
from millrace.plans.cdc_queries import duplicated
from millrace.plans.ingest_queries import place_order_messages
from millrace.plans.inputs import table, table_stream
from millrace.plans.registry import drained, plain_times, query
from millrace.runtime import ROCKSDB_PROVIDER, stored, work_folder
from millrace.sources.envelope import file_stream
from millrace.streaming import stock as stock_ledger
from millrace.streaming.dashboard import dashboard_stream, read_dashboard
from millrace.streaming.keyed import BUCKETS
from millrace.streaming.orchestrator import saga_commands
from millrace.streaming.paid import paid_items_stream, read_paid_items
from millrace.streaming.sinks import append_table
from millrace.streaming.snapshots import snapshot_stream

_TYPE = """CASE event_type WHEN 'signup' THEN 'OrderCreated' WHEN 'purchase' THEN 'PaymentCompleted'
  WHEN 'view' THEN 'StockReserved' WHEN 'click' THEN 'OrderShipped' ELSE 'OrderCancelled' END"""
_LOG = f"""SELECT *, {_TYPE} AS kind,
  CAST(row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS INT) AS version FROM events"""


def _last(value: str, kind: str) -> str:
    return (
        f"last_value(CASE WHEN kind = '{kind}' THEN {value} END IGNORE NULLS) OVER so_far"
    )


# State of every order after each of its events.
_STATES = f"""SELECT user_id AS order_id, event_id AS "offset", version, ts AS occurred_at,
  CASE kind WHEN 'OrderCreated' THEN 'CREATED' WHEN 'PaymentCompleted' THEN 'PAID'
    WHEN 'StockReserved' THEN 'RESERVED' WHEN 'OrderShipped' THEN 'SHIPPED' ELSE 'CANCELLED' END AS status,
  coalesce({_last("'c-' || event_id", 'OrderCreated')}, '') AS customer_id,
  coalesce({_last('value', 'OrderCreated')}, 0.0) AS total,
  'EUR' AS currency,
  {_last("'t-' || event_id", 'PaymentCompleted')} AS transaction_id,
  {_last("'r-' || event_id", 'StockReserved')} AS reservation_id,
  {_last("'TRK-' || event_id", 'OrderShipped')} AS tracking_number,
  {_last("'x-' || event_id", 'OrderCancelled')} AS cancel_reason
  FROM ({_LOG}) WINDOW so_far AS (PARTITION BY user_id ORDER BY event_id)"""
_FINAL = f"""SELECT * EXCLUDE ("offset", n) FROM (SELECT *, row_number() OVER
  (PARTITION BY order_id ORDER BY "offset" DESC) AS n FROM ({{states}}){{where}}) WHERE n = 1"""


def _final(where: str = "") -> str:
    return _FINAL.format(states=_STATES, where=where)


def _log(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.order_events(table(spark, folder, "events"))


@query("classified_events", f"SELECT 'e-' || event_id AS event_id, {_TYPE} AS stated, "
       "CASE event_type WHEN 'purchase' THEN 'PaymentCompleted' WHEN 'view' THEN "
       "'Ambiguous:StockReserved/StockReleased' WHEN 'click' THEN 'OrderShipped' WHEN 'error' THEN "
       "'Ambiguous:PaymentFailed/OrderCancelled' WHEN 'signup' THEN 'OrderCreated' END AS guessed FROM events")
def classified_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event types as stated, and as the fields alone would tell."""
    items = F.when(F.col("event_type") == "OrderCreated", F.array(F.lit(1)))
    log = _log(spark, folder).withColumns(
        {"items": items, "missing_sku": F.lit(None).cast("string"),
         "delivered_at": F.lit(None).cast("timestamp")}
    )
    stated = eventlog.classified(log).withColumnRenamed("event_type", "stated")
    return eventlog.classified(stated).select(
        "event_id", "stated", F.col("event_type").alias("guessed")
    )


@query(
    "orders_created",
    """SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, 1 AS version,
       'OrderCreated' AS event_type, CAST(2 * CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS total,
       'EUR' AS currency, o_orderdate AS occurred_at FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def orders_created(spark: SparkSession, folder: str) -> DataFrame:
    """Accepted PlaceOrder commands as events."""
    parsed = saga.parse_commands(place_order_messages(table(spark, folder, "orders")))
    created = saga.orders_created(saga.accepted_commands(parsed), F.col("o_orderdate"))
    return created.select(
        "order_id", "customer_id", "version", "event_type",
        F.col("total").cast("double").alias("total"), "currency", "occurred_at",
    )


def _order_totals(lineitem: DataFrame) -> DataFrame:
    """OrderCreated events whose totals are the sums of their lines."""
    lines = lineitem.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum(
            F.col("l_quantity").cast("int") * F.col("l_extendedprice").cast("decimal(18,2)")
        ).cast("decimal(18,2)").alias("total")
    )
    return lines.select(
        "order_id",
        F.lit(0).alias("partition"),
        F.col("order_id").alias("offset"),
        F.lit(1).alias("version"),
        F.lit("OrderCreated").alias("event_type"),
        "total",
    )


_TOTALS = """SELECT l_orderkey AS order_id, CAST(sum(CAST(l_quantity AS INT) * CAST(l_extendedprice AS DECIMAL(18,2)))
  AS DECIMAL(18,2)) AS total FROM lineitem GROUP BY 1"""
_PAYMENTS = rf"""SELECT order_id, 2 AS version,
  CASE WHEN total <= 200000 THEN 'PaymentCompleted' ELSE 'PaymentFailed' END AS event_type,
  CASE WHEN total <= 200000 THEN sha256('transaction:' || order_id) END AS transaction_id,
  CASE WHEN total <= 200000 THEN CAST(total AS DOUBLE) END AS amount,
  CASE WHEN total > 200000 THEN 'amount ' || regexp_replace(CAST(total AS VARCHAR), '(\.\d)0$', '\1') || ' exceeds 200000.0' END AS reason FROM ({_TOTALS})"""


def _payments(spark: SparkSession, folder: str) -> DataFrame:
    created = _order_totals(table(spark, folder, "lineitem"))
    # Every order is announced twice; it must be charged once.
    return saga.payment_decisions(created.unionByName(created), max_amount=200_000.0)


@query("payment_decisions", _PAYMENTS)
def payment_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return _payments(spark, folder).select(
        "order_id", "version", "event_type", "transaction_id",
        F.col("amount").cast("double").alias("amount"), "reason",
    )


@query(
    "cancellations",
    f"""SELECT order_id, 3 AS version, 'OrderCancelled' AS event_type, 'payment_failed' AS reason
        FROM ({_PAYMENTS}) WHERE event_type = 'PaymentFailed'""",
)
def cancellations(spark: SparkSession, folder: str) -> DataFrame:
    return saga.cancellations(_payments(spark, folder)).drop("event_id")


# Sequential reservation per SKU; every order line stands for an order of its own,
# placed in the order of (order, part, line, ship date, price).
_STOCK_LINES = """SELECT l_partkey AS sku, CAST(l_quantity AS BIGINT) AS q,
  row_number() OVER (ORDER BY l_orderkey, l_partkey, l_linenumber, l_shipdate, l_extendedprice, l_suppkey, l_quantity) AS "offset"
  FROM lineitem"""
_STOCK = f"""WITH RECURSIVE l AS (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY "offset") AS k FROM ({_STOCK_LINES})),
  f AS (SELECT sku, k, "offset", q, CAST(500 + sku % 100 AS BIGINT) AS before FROM l WHERE k = 1
    UNION ALL SELECT l.sku, l.k, l."offset", l.q, CASE WHEN f.q <= f.before THEN f.before - f.q ELSE f.before END
    FROM f JOIN l ON l.sku = f.sku AND l.k = f.k + 1)
  SELECT "offset", CASE WHEN q <= before THEN 'StockReserved' ELSE 'StockOutOfStock' END AS event_type,
         CASE WHEN q > before THEN sku END AS missing_sku FROM f"""


def single_sku_demands(lineitem: DataFrame) -> DataFrame:
    """Order lines as one-line orders with a global place, read from a stored table.

    The place of a line is its rank. The lines are sorted in ranges, and stored with their
    number within the range; the lines of the ranges before come on top. Ranges are cut by
    all columns of the order, so many lines of one order are spread over them.
    """
    order = ["l_orderkey", "l_partkey", "l_linenumber", "l_shipdate", "l_extendedprice", "l_suppkey", "l_quantity"]
    lines = lineitem.filter("l_orderkey IS NOT NULL AND l_partkey IS NOT NULL").select(order)
    sorted_lines = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    # The id that Spark gives a row: its partition, and in the lower 33 bits its number there.
    placed = stored(
        sorted_lines.select(
            F.monotonically_increasing_id().alias("_id"), "l_partkey", F.col("l_quantity").cast("bigint").alias("quantity")
        ),
        "stock-lines",
    ).withColumn("_range", F.shiftright("_id", 33))
    # One row for each range.
    earlier = Window.partitionBy(F.lit(0)).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = placed.groupBy("_range").agg(F.count("*").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return placed.join(F.broadcast(stored(before, "stock-ranges")), "_range").select(
        place.alias("order_id"), place.alias("offset"), F.lit(0).alias("line_no"), F.col("l_partkey").alias("sku"), "quantity"
    )


@query("stock_decisions", _STOCK)
def stock_decisions(spark: SparkSession, folder: str) -> DataFrame:
    """Reservations in arrival order against a stock of 500 to 599 per part."""
    stock = table(spark, folder, "part").select(
        F.col("p_partkey").alias("sku"), (F.col("p_partkey") % 100 + 500).alias("quantity")
    )
    demands = single_sku_demands(table(spark, folder, "lineitem"))
    return reserve(demands, stock, store=False).select("offset", "event_type", "missing_sku")


@query(
    "stock_held_by_part",
    """SELECT l_partkey AS sku, count(DISTINCT l_orderkey) AS n_asking, false AS oversold
       FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP BY 1""",
)
def stock_held_by_part(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of several lines, paid on three log partitions with equal offsets; every
    seventh gives its stock back later. No part is held beyond its stock at any time:
    what is held at the end of a part's log is its reservations less what came back."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.struct(F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("int").alias("quantity")).alias("item"),
    )
    order = F.col("order_id")
    created = lines.groupBy("order_id").agg(F.sort_array(F.collect_list("item")).alias("items")).select(
        "order_id", "items",
        (order % 3).cast("int").alias("partition"), F.floor(order / 9).alias("offset"),
        F.lit("OrderCreated").alias("event_type"),
    )
    paid = created.filter(order % 11 != 0).withColumns(
        {"items": F.lit(None).cast(created.schema["items"].dataType), "event_type": F.lit("PaymentCompleted")}
    )
    back = created.filter(order % 7 == 0).select(
        "order_id", "partition", (F.col("offset") + F.when(order % 2 == 0, 5).otherwise(-5)).alias("offset")
    )
    stock = table(spark, folder, "part").select(
        F.col("p_partkey").alias("sku"), (F.col("p_partkey") % 100 + 100).alias("quantity")
    )
    demands = demands_of_paid_orders(created.unionByName(paid))
    decided = reserve(demands, stock, back)
    kept = (
        demands.join(decided.select("order_id", F.col("event_type").alias("_event")), "order_id")
        .join(back.filter(order % 2 == 0).select("order_id", F.lit(True).alias("_back")), "order_id", "left")
    )
    held = F.when((F.col("_event") == RESERVED) & F.col("_back").isNull(), F.col("quantity")).otherwise(0)
    return (
        kept.groupBy("sku")
        .agg(F.count_distinct("order_id").alias("n_asking"), F.sum(held).alias("_held"))
        .join(stock, "sku")
        .select("sku", "n_asking", (F.col("_held") > F.col("quantity")).alias("oversold"))
    )


# Orders of several lines in independent shops of five SKUs each; every seventh order gives
# its stock back once the second order after it in its shop has asked. One step of the
# recursion is one entry of every shop.
_SHOPS, _SKUS = 500, 5
_SHOP_STOCK = f"""WITH RECURSIVE line AS (
    SELECT l_orderkey AS o, CAST(l_partkey % {_SKUS} AS INT) AS s, CAST(sum(l_quantity) AS BIGINT) AS q, min(l_linenumber) AS n
    FROM lineitem GROUP BY ALL),
  ord AS (SELECT o, o % {_SHOPS} AS g, row_number() OVER (PARTITION BY o % {_SHOPS} ORDER BY o) AS j,
    list(s ORDER BY n, s) AS skus, map(list(s), list(q)) AS m FROM line GROUP BY o),
  e AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY pl, back) AS k FROM (
    SELECT g, j, o, skus, list_transform(range({_SKUS}), lambda s: coalesce(m[s], 0)) AS need, j AS pl, false AS back FROM ord
    UNION ALL SELECT g, j, o, skus, list_transform(range({_SKUS}), lambda s: coalesce(m[s], 0)), j + 2, true FROM ord WHERE o % 7 = 0)),
  f AS (SELECT g, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS o, false AS back, CAST([150, 150, 150, 150, 150] AS BIGINT[]) AS stock,
      CAST([] AS BOOLEAN[]) AS taken, CAST(NULL AS INT) AS missing FROM ord GROUP BY g
    UNION ALL SELECT g, k, o, back,
      CASE WHEN back AND taken[j] THEN list_transform(need, lambda x, i: x + stock[i])
        WHEN NOT back AND lacking IS NULL THEN list_transform(need, lambda x, i: stock[i] - x) ELSE stock END,
      CASE WHEN back THEN taken ELSE list_append(taken, lacking IS NULL) END, CASE WHEN NOT back THEN lacking END
    FROM (SELECT f.g, e.k, e.o, e.back, e.j, e.need, f.stock, f.taken,
        list_filter(e.skus, lambda s: e.need[s + 1] > f.stock[s + 1])[1] AS lacking
      FROM f JOIN e ON e.g = f.g AND e.k = f.k + 1))
  SELECT o AS order_id, CASE WHEN missing IS NULL THEN 'StockReserved' ELSE 'StockOutOfStock' END AS event_type,
    CASE WHEN missing IS NOT NULL THEN g || '-' || missing END AS missing_sku FROM f WHERE k > 0 AND NOT back"""


def _shop_entries(lineitem: DataFrame) -> DataFrame:
    """Requests and releases of the shops' orders, placed by order and, for releases, just
    behind the second order after their own in the shop."""
    order = F.col("l_orderkey")
    sku = F.concat_ws("-", order % _SHOPS, F.col("l_partkey") % _SKUS)
    lines = lineitem.groupBy(order.alias("order_id"), sku.alias("sku")).agg(
        F.sum("l_quantity").cast("int").alias("quantity"), F.min("l_linenumber").alias("n")
    )
    items = F.transform(
        F.sort_array(F.collect_list(F.struct("n", "sku", "quantity"))),
        lambda x: F.struct(x["sku"].alias("sku"), x["quantity"].alias("quantity")),
    )
    shop = Window.partitionBy("shop").orderBy("order_id")
    orders = lines.groupBy("order_id").agg(items.alias("items")).withColumn("shop", F.col("order_id") % _SHOPS)
    # A shop is a fixed fraction of the orders here; its rank is the place of its orders.
    placed = orders.withColumns({"at": F.row_number().over(shop).cast("bigint"), "partition": F.lit(0)})
    requests = placed.select(
        "order_id", F.lit("request").alias("kind"), (F.col("at") * 2).alias("at"), "partition",
        F.col("order_id").alias("offset"), "items",
    )
    releases = placed.filter(F.col("order_id") % 7 == 0).select(
        "order_id", F.lit("release").alias("kind"), (F.col("at") * 2 + 5).alias("at"), "partition",
        F.col("order_id").alias("offset"), F.lit(None).cast(requests.schema["items"].dataType).alias("items"),
    )
    return requests.unionByName(releases)


def _shop_stock(entries: DataFrame) -> DataFrame:
    """150 of each of the five SKUs of every shop that has an order."""
    shops = entries.select((F.col("order_id") % _SHOPS).alias("shop")).distinct()
    numbers = F.explode(F.sequence(F.lit(0), F.lit(_SKUS - 1)))
    return shops.select("shop", numbers.alias("n")).select(
        F.concat_ws("-", "shop", "n").alias("sku"), F.lit(150).alias("quantity")
    )


@query("stock_of_shops", _SHOP_STOCK)
def stock_of_shops(spark: SparkSession, folder: str) -> DataFrame:
    """Every verdict on orders of several lines, with releases, in one run."""
    entries = stored(_shop_entries(table(spark, folder, "lineitem")), "shop-entries")
    lines = entries.filter("kind = 'request'").select(
        "order_id", "at", "partition", "offset", F.posexplode("items").alias("line_no", "item")
    )
    demands = lines.select("order_id", "at", "partition", "offset", "line_no", "item.*")
    releases = entries.filter("kind = 'release'").select("order_id", "at", "partition", "offset")
    return reserve(demands, _shop_stock(entries), releases).drop("offset")


@query("stock_of_shops_streamed", _SHOP_STOCK)
def stock_of_shops_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same in three micro-batches against standing balances."""
    work = work_folder(spark, "shops")
    entries = stored(_shop_entries(table(spark, folder, "lineitem")), "shop-entries")
    stock_ledger.open_ledger(f"{work}/ledger", _shop_stock(entries))
    last = entries.agg(F.max("at")).first()[0]
    batch = F.least(F.lit(2), F.floor(F.col("at") * 3 / F.lit(last + 1)))
    for stream in inputs.arriving(entries, batch, 3, f"{work}/entries"):
        stock_ledger.reserve_stream(
            stream, f"{work}/ledger", f"{work}/checkpoint", every=None, compact_every=2
        ).awaitTermination()
    return stock_ledger.decisions(spark, f"{work}/ledger").drop("offset")


@query(
    "compensations",
    f"""WITH f AS (SELECT user_id AS order_id,
          min(event_id) FILTER (WHERE kind = 'OrderCancelled') AS cancelled,
          arg_min(version, event_id) FILTER (WHERE kind = 'OrderCancelled') AS v,
          min(event_id) FILTER (WHERE kind = 'StockReserved') AS reserved,
          min(event_id) FILTER (WHERE kind = 'PaymentCompleted') AS paid FROM ({_LOG}) GROUP BY 1)
      SELECT order_id, v + 1 AS version, 'StockReleased' AS event_type, 'released-' || order_id AS reservation_id
        FROM f WHERE reserved < cancelled
      UNION ALL SELECT order_id, v + 1, 'PaymentRefunded', NULL FROM f WHERE paid < cancelled""",
)
def compensations(spark: SparkSession, folder: str) -> DataFrame:
    """Releases and refunds of cancelled orders."""
    return saga.compensations(_log(spark, folder), refunds=True).drop("event_id")


@query(
    "shipments",
    f"""SELECT user_id AS order_id, version + step AS version,
        CASE step WHEN 1 THEN 'OrderShipped' ELSE 'OrderDelivered' END AS event_type,
        CASE step WHEN 1 THEN ts ELSE ts + INTERVAL 2 SECOND END AS occurred_at,
        CASE step WHEN 1 THEN 'TRK-' || upper(substr(sha256('tracking:' || user_id), 1, 10)) END AS tracking_number,
        CASE step WHEN 1 THEN 'UPS' END AS carrier,
        CASE step WHEN 2 THEN ts + INTERVAL 2 SECOND END AS delivered_at
        FROM ({_LOG}), (SELECT CAST(unnest([1, 2]) AS INT) AS step) WHERE kind = 'StockReserved'""",
)
def shipments(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(saga.shipments(_log(spark, folder)).drop("event_id"))


@query("order_states", _final())
def order_states(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(eventlog.fold(_log(spark, folder)))


@query("order_states_once", _final())
def order_states_once(spark: SparkSession, folder: str) -> DataFrame:
    """Events delivered twice leave the states as they are."""
    log = _log(spark, folder)
    twice = log.unionByName(log)
    return plain_times(eventlog.fold(once_per_event(twice)))


@query("replayed_order", _final(" WHERE order_id = 8"))
def replayed_order(spark: SparkSession, folder: str) -> DataFrame:
    """One order rebuilt from the log."""
    return plain_times(eventlog.replay_order(_log(spark, folder), 8))


@query("order_states_at_version", _final(" WHERE version <= 10"))
def order_states_at_version(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(eventlog.at_version(_log(spark, folder), 10))


_SNAPSHOTS = f"""SELECT order_id, "offset", version, occurred_at AS snapshot_at, status, customer_id, total, currency,
  transaction_id, reservation_id, tracking_number, cancel_reason FROM ({_STATES}) WHERE version % 5 = 0"""


@query("order_snapshots", _SNAPSHOTS)
def order_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return plain_times(eventlog.snapshots(_log(spark, folder)).drop("partition"))


@query("order_snapshots_streamed", _SNAPSHOTS)
def order_snapshots_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same snapshots from keyed state, as the events arrive."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    # Versions need the whole log, so the log is written first and then streamed.
    path = f"{work_folder(spark, 'log')}/events"
    log = _log(spark, folder)
    log.write.parquet(path)
    stream = snapshot_stream(file_stream(spark, path, log.schema), buckets=BUCKETS)
    return plain_times(drained(stream, "snapshots").drop("partition"))


@query("bootstrapped_states", _final())
def bootstrapped_states(spark: SparkSession, folder: str) -> DataFrame:
    """Latest snapshots and the events after them give the states of a full replay."""
    log = _log(spark, folder)
    return plain_times(eventlog.bootstrap(eventlog.snapshots(log), log))


@query("tail_bootstrapped_states", _final())
def tail_bootstrapped_states(spark: SparkSession, folder: str) -> DataFrame:
    """States from stored snapshots and the tail of the log: snapshots are taken when the
    log has a third and two thirds of its events, and everything before the marks is gone
    from the log afterwards."""
    work = work_folder(spark, "tail")
    log = _log(spark, folder)
    log.write.parquet(f"{work}/all")
    everything = spark.read.schema(log.schema).parquet(f"{work}/all")
    end = everything.agg(F.max("offset")).first()[0]
    left = everything
    for third in (1, 2):
        arrived = left.filter(F.col("offset") <= end * third // 3)
        marks = eventlog.write_snapshots(arrived, f"{work}/snapshots", keep=end // 10)
        eventlog.tail_of(left, marks).write.parquet(f"{work}/after={third}")
        left = spark.read.schema(log.schema).parquet(f"{work}/after={third}")
    return plain_times(eventlog.bootstrap_stored(f"{work}/snapshots", left))


@query(
    "saga_paths",
    f"""WITH f AS (SELECT user_id AS order_id,
        min(event_id) FILTER (WHERE kind = 'OrderCreated') AS a, min(event_id) FILTER (WHERE kind = 'PaymentCompleted') AS b,
        min(event_id) FILTER (WHERE kind = 'StockReserved') AS c, min(event_id) FILTER (WHERE kind = 'OrderShipped') AS d
        FROM ({_LOG}) GROUP BY 1)
      SELECT order_id, a AS "first_OrderCreated", b AS "first_PaymentCompleted", c AS "first_StockReserved",
        d AS "first_OrderShipped", a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL AND d IS NOT NULL AS complete,
        coalesce(a < b, false) AND coalesce(b < c, false) AND coalesce(c < d, false) AS in_order FROM f""",
)
def saga_paths(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.saga_paths(_log(spark, folder))


_COMMANDS = " UNION ALL ".join(
    f"SELECT order_id, version, status, '{command}' AS command FROM s WHERE {test}"
    for command, test in (
        ("ChargePayment", "status = 'CREATED'"),
        ("ReserveStock", "status = 'PAID'"),
        ("ShipOrder", "status = 'RESERVED'"),
        ("RefundPayment", "status = 'CANCELLED' AND transaction_id IS NOT NULL"),
        ("ReleaseStock", "status = 'CANCELLED' AND reservation_id IS NOT NULL"),
    )
)


@query("next_commands", f"WITH s AS ({_final()}) {_COMMANDS}")
def next_commands(spark: SparkSession, folder: str) -> DataFrame:
    return saga.next_commands(eventlog.fold(_log(spark, folder)))


@query(
    "orders_per_day_and_status",
    f"SELECT CAST(occurred_at AS DATE) AS day, status, count(*) AS n_orders FROM ({_final()}) GROUP BY 1, 2",
)
def orders_per_day_and_status(spark: SparkSession, folder: str) -> DataFrame:
    return eventlog.daily_dashboard(_log(spark, folder))


@query(
    "orders_per_day_and_status_streamed",
    f"SELECT CAST(occurred_at AS DATE) AS day, status, count(*) AS n_orders FROM ({_final()}) GROUP BY 1, 2",
)
def orders_per_day_and_status_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """The same dashboard from three micro-batches, by taking orders out of the cells they leave."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    work = work_folder(spark, "dashboard")
    log = stored(_log(spark, folder), "dashboard-log")
    third = F.floor((F.col("offset") - 1) * 3 / log.count())
    for stream in inputs.arriving(log, F.greatest(F.lit(0), F.least(F.lit(2), third)), 3, f"{work}/log"):
        dashboard_stream(stream, f"{work}/table", f"{work}/checkpoint", every=None, buckets=BUCKETS).awaitTermination()
    return read_dashboard(spark, f"{work}/table")


# Sagas by order: 0 runs through, 1 is refused, 2 runs out of stock, 3 to 5 fall silent after
# the creation, the payment and the reservation. Steps are an hour apart.
_STEPS = ("OrderCreated", "PaymentCompleted", "StockReserved", "OrderShipped")
_SAGA_COMMANDS = """WITH k AS (SELECT o_orderkey AS order_id, o_orderkey % 6 AS kind,
    TIMESTAMP '2024-01-01' + to_seconds(o_orderkey % 600) AS t FROM orders),
  c AS (SELECT unnest([
    {'kind': 0, 'step': 0, 'command': 'ChargePayment', 'reason': NULL}, {'kind': 0, 'step': 1, 'command': 'ReserveStock', 'reason': NULL},
    {'kind': 0, 'step': 2, 'command': 'ShipOrder', 'reason': NULL}, {'kind': 1, 'step': 0, 'command': 'ChargePayment', 'reason': NULL},
    {'kind': 1, 'step': 1, 'command': 'CancelOrder', 'reason': 'payment_failed'},
    {'kind': 2, 'step': 0, 'command': 'ChargePayment', 'reason': NULL}, {'kind': 2, 'step': 1, 'command': 'ReserveStock', 'reason': NULL},
    {'kind': 2, 'step': 2, 'command': 'CancelOrder', 'reason': 'out_of_stock'},
    {'kind': 2, 'step': 2, 'command': 'RefundPayment', 'reason': 'out_of_stock'},
    {'kind': 3, 'step': 0, 'command': 'ChargePayment', 'reason': NULL}, {'kind': 3, 'step': 1.5, 'command': 'CancelOrder', 'reason': 'timed_out'},
    {'kind': 4, 'step': 0, 'command': 'ChargePayment', 'reason': NULL}, {'kind': 4, 'step': 1, 'command': 'ReserveStock', 'reason': NULL},
    {'kind': 4, 'step': 2.5, 'command': 'CancelOrder', 'reason': 'timed_out'}, {'kind': 4, 'step': 2.5, 'command': 'RefundPayment', 'reason': 'timed_out'},
    {'kind': 5, 'step': 0, 'command': 'ChargePayment', 'reason': NULL}, {'kind': 5, 'step': 1, 'command': 'ReserveStock', 'reason': NULL},
    {'kind': 5, 'step': 2, 'command': 'ShipOrder', 'reason': NULL}, {'kind': 5, 'step': 3.5, 'command': 'CancelOrder', 'reason': 'timed_out'},
    {'kind': 5, 'step': 3.5, 'command': 'RefundPayment', 'reason': 'timed_out'}, {'kind': 5, 'step': 3.5, 'command': 'ReleaseStock', 'reason': 'timed_out'}
  ], recursive := true))
  SELECT order_id, command, reason, t + to_minutes(CAST(60 * step AS INT)) AS "at" FROM k JOIN c USING (kind)"""


def _saga_events(orders: DataFrame) -> DataFrame:
    """``step`` and the events of each saga; the creation of every fifth order is delivered
    again with the step after it. A last event far ahead lets all timers run out."""
    order, kind = F.col("o_orderkey"), F.col("o_orderkey") % 6
    steps = F.when(kind == 1, F.array(F.lit(_STEPS[0]), F.lit("PaymentFailed")))
    steps = steps.when(kind == 2, F.array(F.lit(_STEPS[0]), F.lit(_STEPS[1]), F.lit("StockOutOfStock")))
    last = F.when(kind == 0, 4).otherwise(kind - 2)
    steps = steps.otherwise(F.slice(F.array(*map(F.lit, _STEPS)), F.lit(1), last.cast("int")))
    every = orders.select(order.alias("order_id"), F.posexplode(steps).alias("step", "event_type"))
    again = every.filter((F.col("order_id") % 5 == 0) & (F.col("step") == 0))
    every = every.withColumn("batch", F.col("step")).unionByName(again.withColumn("batch", F.lit(1)))
    ahead = orders.sparkSession.range(1).select(
        F.lit(-1).cast("bigint").alias("order_id"), F.lit(100).alias("step"), F.lit("OrderShipped").alias("event_type"),
        F.lit(4).alias("batch"),
    )
    at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(hours=F.col("step"), secs=F.pmod(F.col("order_id"), F.lit(600)).cast("decimal(18,6)"))
    return every.unionByName(ahead).select(
        "order_id", F.lit(0).alias("partition"), F.col("step").cast("bigint").alias("offset"), "event_type",
        at.alias("occurred_at"), "batch",
        F.when(F.col("event_type") == _STEPS[1], F.concat(F.lit("t-"), "order_id")).alias("transaction_id"),
        F.when(F.col("event_type") == _STEPS[2], F.concat(F.lit("r-"), "order_id")).alias("reservation_id"),
    )


@query("saga_commands_streamed", _SAGA_COMMANDS)
def saga_commands_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Commands of an orchestrator that is started anew for each of five arrivals, with
    sagas that finish, fail and fall silent."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    work = work_folder(spark, "orchestrator")
    events = _saga_events(table(spark, folder, "orders"))
    for stream in inputs.arriving(events, F.col("batch"), 5, f"{work}/events"):
        commands = saga_commands(stream, timeout_seconds=90 * 60, buckets=BUCKETS)
        append_table(commands, f"{work}/commands", f"{work}/checkpoint", every=None).awaitTermination()
    return plain_times(spark.read.parquet(f"{work}/commands"))


# Created orders arrive in one of three batches by their key, payments in another one.
_PAID_ITEMS = """SELECT l_orderkey AS order_id, l_partkey AS sku, CAST(l_quantity AS INT) AS quantity,
    TIMESTAMP '2024-01-01' + to_seconds(l_orderkey % 3 * 3600 + l_orderkey % 1800) + to_minutes(CAST(l_orderkey % 20 AS INT)) AS paid_at
  FROM lineitem WHERE l_orderkey % 11 <> 0 AND l_orderkey % 20 <= 15 AND l_orderkey IN (SELECT o_orderkey FROM orders)"""


@query("paid_items_streamed", _PAID_ITEMS)
def paid_items_streamed(spark: SparkSession, folder: str) -> DataFrame:
    """Items of paid orders from two streams: a payment arrives in a batch before, with or
    after that of its order. Some orders are not paid, some too late, some twice."""
    work = work_folder(spark, "paid")
    order = F.col("order_id")
    item = F.struct("l_linenumber", F.col("l_partkey").alias("sku"), F.col("l_quantity").cast("int").alias("quantity"))
    lines = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sort_array(F.collect_list(item)).alias("items")
    )
    known = table(spark, folder, "orders").select(F.col("o_orderkey").alias("order_id"))
    seconds = (order % 3 * 3600 + order % 1800).cast("decimal(18,6)")
    created_at = F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(secs=seconds)
    created = lines.join(known, "order_id").select("order_id", "items", created_at.alias("created_at"))
    paid = created.filter(order % 11 != 0).select(
        "order_id",
        (F.col("created_at") + F.make_dt_interval(mins=(order % 20).cast("int"))).alias("paid_at"),
        F.lit(0).alias("partition"), order.alias("offset"),
    )
    paid = paid.withColumn("_n", F.explode(F.when(order % 10 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("_n")
    orders = inputs.arriving(created, order % 3, 3, f"{work}/created")
    payments = inputs.arriving(paid, F.floor(order / 3) % 3, 3, f"{work}/payments")
    for left, right in zip(orders, payments):
        paid_items_stream(
            left, right, f"{work}/table", f"{work}/checkpoint", within_seconds=15 * 60, watermark="4 hours", every=None
        ).awaitTermination()
    items = read_paid_items(spark, f"{work}/table").select("order_id", "paid_at", F.explode("items").alias("i"))
    return plain_times(items.select("order_id", "i.sku", "i.quantity", "paid_at"))


@query(
    "reservation_items",
    """SELECT o_orderkey AS order_id, l_partkey AS sku, l_linenumber AS line_no, l_quantity AS quantity,
       o_orderdate AS paid_at FROM orders JOIN lineitem ON o_orderkey = l_orderkey""",
)
def reservation_items(spark: SparkSession, folder: str) -> DataFrame:
    """Lines to reserve when an order is paid: payments joined to the order's lines."""
    paid = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("paid_at")
    )
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku"),
        F.col("l_linenumber").alias("line_no"), F.col("l_quantity").alias("quantity"),
    )
    return paid.join(lines, "order_id")
