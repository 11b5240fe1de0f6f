"""Queries over messages, bronze tables and stored files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import framing, shaping
from millrace.functions.cdc import unwrap
from millrace.operators import counts
from millrace.operators.latest import newest, soft_deletes
from millrace.operators.running import Running, offset_chunk, running
from millrace.plans import inputs
from millrace.plans.inputs import table, table_stream
from millrace.plans.jobs import bronze_job
from millrace.plans.registry import plain_times, query
from millrace.runtime import work_folder
from millrace.schemas import CDC_ORDER, CDC_SOURCE, ORDER_MODEL, struct
from millrace.sources import bounded
from millrace.sources import envelope as E
from millrace.sources.tables import file_inventory, read_partitioned
from millrace.streaming import sinks

_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"
_FRAME = """CASE WHEN event_id % 19 = 0 THEN 'tombstone' WHEN event_id % 17 = 0 THEN 'short_frame'
  WHEN event_id % 13 = 0 THEN 'empty_payload' WHEN event_id % 11 = 0 THEN 'bad_magic'"""


@query(
    "envelope_frames",
    f"""SELECT event_id AS "offset", {_FRAME} ELSE 'framed' END AS frame,
       CASE WHEN event_id % 19 <> 0 AND event_id % 17 <> 0 AND (event_id % 13 = 0 OR event_id % 11 <> 0)
            AND event_id % 13 <> 0 THEN 7 END AS schema_id
       FROM events""",
)
def envelope_frames(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    broken = framing.frame_error(value)
    return inputs.messages(table(spark, folder, "events")).select(
        "offset",
        F.coalesce(broken, F.lit("framed")).alias("frame"),
        F.when(broken.isNull(), framing.schema_id(value)).alias("schema_id"),
    )


def _stored_messages(spark: SparkSession, folder: str, work: str) -> str:
    path = f"{work}/messages"
    inputs.messages(table(spark, folder, "events")).write.parquet(path)
    return path


_GOOD = "event_id % 19 <> 0 AND event_id % 17 <> 0 AND event_id % 13 <> 0 AND event_id % 11 <> 0 AND event_id % 7 <> 0"


@query(
    "bronze_orders",
    f"""SELECT CAST(user_id AS VARCHAR) AS kafka_key, CAST(user_id AS INT) AS order_id,
       CAST(event_id AS INT) AS customer_id, event_type AS status, value AS total_amount,
       'EUR' AS currency, {_OP} AS op, epoch_us(ts) // 1000 AS cdc_ts_ms,
       'shop.public.' || event_type AS topic, CAST(user_id % 3 AS INT) AS "partition",
       event_id AS "offset", ts AS kafka_ts, TIMESTAMP '2024-02-01 00:00:00' AS ingested_at,
       'orders' AS bronze_layer FROM events WHERE {_GOOD}""",
)
def bronze_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Messages through the bronze job; broken ones went to the dead letters."""
    work = work_folder(spark, "bronze")
    stream = E.file_stream(spark, _stored_messages(spark, folder, work))
    bronze_job(
        stream, f"{work}/orders", f"{work}/checkpoint", f"{work}/dead",
        every=None, ingested_at=datetime(2024, 2, 1),
    ).awaitTermination()
    rows = spark.read.parquet(f"{work}/orders").select(
        "kafka_key", "order_id", "customer_id", "status", "total_amount", "currency", "op",
        "cdc_ts_ms", "topic", "partition", "offset", "kafka_ts", "ingested_at", "bronze_layer",
    )
    return plain_times(rows)


@query(
    "dead_letters",
    f"""SELECT 'shop.public.' || event_type AS topic, CAST(user_id % 3 AS INT) AS "partition",
       event_id AS "offset", {_FRAME} ELSE 'undecodable' END AS error_class,
       {_FRAME} ELSE 'undecodable' END || ' at shop.public.' || event_type || ':' || (user_id % 3) || ':' || event_id
         AS error_message
       FROM events WHERE NOT ({_GOOD})""",
)
def dead_letters(spark: SparkSession, folder: str) -> DataFrame:
    decoded = E.decode(
        inputs.messages(table(spark, folder, "events")), E.json_payload(CDC_ORDER), ["order_id"]
    )
    return E.dead_letters(decoded).select(
        "topic", "partition", "offset", "error_class", "error_message"
    )


@query(
    "topic_selection",
    """SELECT event_id AS "offset", 'shop.public.' || event_type AS topic,
       'bronze.' || event_type AS bronze_topic, ts AS kafka_ts
       FROM events WHERE event_type IN ('view', 'purchase')""",
)
def topic_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Topics by pattern, renamed for the next layer."""
    chosen = E.topics_matching(
        inputs.messages(table(spark, folder, "events")), r"shop\.public\.(view|purchase)"
    )
    renamed = shaping.rewrite_topic(F.col("topic"), r"shop\.public\.(.*)", "bronze.$1")
    return plain_times(
        E.as_text(chosen).select("offset", "topic", renamed.alias("bronze_topic"), "kafka_ts")
    )


def _change_envelopes(orders: DataFrame) -> DataFrame:
    """Orders as change envelopes: F was updated, O created, P deleted."""
    image = F.struct(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
    )
    status = F.col("o_orderstatus")
    ts_ms = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    source = F.struct(
        F.lit("1").alias("version"), F.lit("pg").alias("connector"), F.lit("shop").alias("name"),
        ts_ms.alias("ts_ms"), F.col("o_orderkey").alias("lsn"), F.lit(None).cast("bigint").alias("txId"),
        F.lit("orders").alias("table"),
    ).cast(CDC_SOURCE)
    return orders.select(
        F.when(status != "O", image).alias("before"),
        F.when(status != "P", image).alias("after"),
        source.alias("source"),
        F.when(status == "O", "c").when(status == "F", "u").otherwise("d").alias("op"),
        ts_ms.alias("ts_ms"),
    )


_UNWRAPPED = """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS total_amount,
  CASE WHEN o_orderstatus = 'P' THEN 'true' ELSE 'false' END AS __deleted,
  CASE o_orderstatus WHEN 'O' THEN 'c' WHEN 'F' THEN 'u' ELSE 'd' END AS __op,
  'orders' AS __table, epoch_us(o_orderdate) // 1000 AS __source_ts_ms, o_orderkey AS __source_lsn
  FROM orders"""


@query("cdc_unwrapped", _UNWRAPPED)
def cdc_unwrapped(spark: SparkSession, folder: str) -> DataFrame:
    return unwrap(_change_envelopes(table(spark, folder, "orders")))


@query(
    "soft_deletes_newest",
    f"""SELECT order_id, __deleted, __op, __source_ts_ms FROM ({_UNWRAPPED})
        ORDER BY __source_ts_ms DESC, order_id LIMIT 20""",
)
def soft_deletes_newest(spark: SparkSession, folder: str) -> DataFrame:
    changes = unwrap(_change_envelopes(table(spark, folder, "orders")), F.lit("orders"))
    return soft_deletes(changes, 20, "order_id")


@query(
    "masked_contacts",
    """SELECT c_custkey, 'internal' AS route, c_name AS contact FROM customer
       UNION ALL SELECT c_custkey, 'shared', sha256(c_name) FROM customer""",
)
def masked_contacts(spark: SparkSession, folder: str) -> DataFrame:
    """One copy as it is, one with the contact masked."""
    rows = table(spark, folder, "customer").select("c_custkey", F.col("c_name").alias("contact"))
    open_copy = rows.withColumn("route", F.lit("internal"))
    return open_copy.unionByName(
        shaping.masked(rows, "contact").withColumn("route", F.lit("shared"))
    )


@query(
    "schema_versions",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, CAST(o_custkey AS VARCHAR) AS customer_id,
       o_totalprice AS total, 'EUR' AS currency, o_orderdate AS created_at,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS discount_code FROM orders""",
)
def schema_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Old and new record versions in one frame; old ones lack the discount code."""
    orders = table(spark, folder, "orders")
    common = [
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_totalprice").alias("total"),
        F.lit("EUR").alias("currency"),
        F.col("o_orderdate").alias("created_at"),
    ]
    old = orders.filter("o_orderstatus = 'F'").select(*common)
    new = orders.filter("o_orderstatus <> 'F'").select(
        *common, F.col("o_orderpriority").alias("discount_code")
    )
    return shaping.union_versions(old, new)


_V1 = struct("id STRING, customer_id STRING, total DOUBLE, currency STRING, created_at BIGINT")
_V2 = struct("id STRING, customer_id STRING, total DOUBLE, currency STRING, created_at BIGINT, discount_code STRING")
# Old orders have schema 11, open ones 12; pending ones an id nobody knows. Every 17th payload
# is cut off, every 19th old one states a total that is no number.
_BY_ID = """SELECT o_orderkey AS "offset", CASE WHEN known AND ok THEN CAST(o_orderkey AS VARCHAR) END AS id,
    CASE WHEN known AND ok THEN o_totalprice END AS total,
    CASE WHEN known AND ok THEN epoch_us(o_orderdate) // 1000 END AS created_at,
    CASE WHEN known AND ok AND o_orderstatus = 'O' THEN o_orderpriority END AS discount_code,
    CASE WHEN NOT known THEN 'unknown_schema' WHEN NOT ok THEN 'undecodable' END AS error_class
  FROM (SELECT *, o_orderstatus <> 'P' AS known,
    o_orderkey % 17 <> 0 AND (o_orderstatus <> 'F' OR o_orderkey % 19 <> 0) AS ok FROM orders)"""


@query("decoded_by_schema_id", _BY_ID)
def decoded_by_schema_id(spark: SparkSession, folder: str) -> DataFrame:
    """Old and new record versions in one batch, each read by the schema its frame names."""
    orders, order = table(spark, folder, "orders"), F.col("o_orderkey")
    status = F.col("o_orderstatus")
    odd = (status == "F") & (order % 19 == 0)
    fields = [
        order.cast("string").alias("id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(~odd, F.col("o_totalprice")).alias("total"),
        F.lit("EUR").alias("currency"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("created_at"),
    ]
    text = F.when(status == "O", F.to_json(F.struct(*fields, F.col("o_orderpriority").alias("discount_code"))))
    text = text.otherwise(F.to_json(F.struct(*fields)))
    text = F.when(odd, F.concat(F.lit('{"total":"n/a",'), F.substr(text, F.lit(2)))).otherwise(text)
    text = F.when(order % 17 == 0, F.substring(text, 1, 20)).otherwise(text)
    framed = F.when(status == "F", framing.add_frame(text, 11)).when(status == "O", framing.add_frame(text, 12))
    messages = orders.select(
        F.lit(None).cast("binary").alias("key"), framed.otherwise(framing.add_frame(text, 99)).alias("value"),
        F.lit("orders").alias("topic"), F.lit(0).alias("partition"), order.alias("offset"),
        F.col("o_orderdate").cast("timestamp").alias("timestamp"), F.lit(0).alias("timestampType"),
    )
    decoded = E.decode_by_id(
        messages, {11: (_V1, E.json_payload(_V1)), 12: (_V2, E.json_payload(_V2))}, _V2, ["id"]
    )
    return decoded.select("offset", "data.id", "data.total", "data.created_at", "data.discount_code", "error_class")


@query(
    "typed_orders",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total_amount, CAST(NULL AS VARCHAR) AS currency,
       o_orderdate AS created_at, CAST(NULL AS TIMESTAMP) AS updated_at FROM orders""",
)
def typed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders in the model's types; fields the source lacks are null."""
    rows = table(spark, folder, "orders").select(
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
    )
    model = shaping.typed(rows, ORDER_MODEL)
    return plain_times(model.withColumn("total_amount", F.col("total_amount").cast("double")))


@query(
    "item_totals",
    """SELECT l_orderkey, l_partkey, l_linenumber, l_quantity,
       CAST(round(CAST(CAST(l_quantity AS INT) AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2))
            + 2 * CAST(l_tax AS DECIMAL(18,2)), 2) AS DOUBLE) AS total FROM lineitem""",
)
def item_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Total of nested order lines."""
    items = F.array(
        F.struct(F.col("l_quantity").cast("int").alias("quantity"), F.col("l_extendedprice").alias("unit_price")),
        F.struct(F.lit(2).alias("quantity"), F.col("l_tax").alias("unit_price")),
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
        shaping.items_total(items).cast("double").alias("total"),
    )


@query(
    "json_republished",
    f"""SELECT CAST(user_id AS VARCHAR) AS key,
       '{{"offset":' || event_id || ',"order_id":' || user_id || ',"op":"' || {_OP} || '","status":"' || event_type || '"}}'
         AS value FROM events""",
)
def json_republished(spark: SparkSession, folder: str) -> DataFrame:
    """A stream written out as keyed JSON messages."""
    work = work_folder(spark, "republished")
    changes = inputs.cdc_log(table_stream(spark, folder, "events"))
    sinks.republish_json(
        changes.select("offset", "order_id", "op", "status"), "order_id",
        f"{work}/checkpoint", every=None, folder=f"{work}/messages",
    ).awaitTermination()
    return spark.read.parquet(f"{work}/messages")


@query(
    "rows_per_day_folder",
    """SELECT CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(day(ts) AS INT) AS day,
       count(*) AS n_rows FROM events GROUP BY 1, 2, 3""",
)
def rows_per_day_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly folders written by record time, counted back by day."""
    work = work_folder(spark, "by-hour")
    rows = inputs.cdc_log(table(spark, folder, "events")).withColumn("topic", F.lit("orders"))
    sinks.write_time_partitioned(rows, f"{work}/bronze")
    stored = read_partitioned(spark, f"{work}/bronze", topic="orders")
    return counts.rows_per_partition(stored)


@query(
    "rows_per_file_set",
    """SELECT 'events' AS name, count(*) AS n_rows FROM events UNION ALL
       SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'customer', count(*) FROM customer""",
)
def rows_per_file_set(spark: SparkSession, folder: str) -> DataFrame:
    """Row counts of tables by way of their file inventories."""
    found = None
    for name in ("events", "orders", "customer"):
        files = file_inventory(spark, f"{folder}/{name}.parquet")
        one = files.agg(F.sum("n_rows").alias("n_rows")).select(F.lit(name).alias("name"), "n_rows")
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "order_within_keys",
    """SELECT user_id AS order_id, CAST(1 AS BIGINT) AS n_partitions, count(*) AS n_events,
       true AS in_order FROM events GROUP BY 1""",
)
def order_within_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keyed partitioning keeps each key in one partition, in arrival order."""
    keyed = sinks.keyed_partitions(inputs.cdc_log(table(spark, folder, "events")), "order_id")
    placed = keyed.select(
        "order_id", "offset",
        F.spark_partition_id().alias("_p"),
        F.monotonically_increasing_id().alias("_i"),
    )
    # In order means: each row's offset is above that of the row before it.
    arrived = running(
        placed, ["order_id"], ["_i"], offset_chunk(F.col("_i")),
        Running(lags={"_before": F.col("offset")}),
    )
    return arrived.groupBy("order_id").agg(
        F.countDistinct("_p").alias("n_partitions"),
        F.count("*").alias("n_events"),
        F.bool_and(F.coalesce(F.col("_before") < F.col("offset"), F.lit(True))).alias("in_order"),
    )


@query(
    "bounded_read",
    """SELECT CAST(user_id % 3 AS INT) AS "partition", count(*) AS n_read, max(event_id) AS last_offset
       FROM events WHERE event_id <= (SELECT count(*) // 2 FROM events) GROUP BY 1""",
)
def bounded_read(spark: SparkSession, folder: str) -> DataFrame:
    """Log read up to the end offsets known when it was half as long; the rest stays unread."""
    log = table(spark, folder, "events").select(
        (F.col("user_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset")
    )
    known = log.filter(F.col("offset") <= log.count() // 2)
    read = bounded.read_until(log, bounded.end_offsets(known))
    return read.groupBy("partition").agg(
        F.count("*").alias("n_read"), F.max("offset").alias("last_offset")
    )


@query(
    "outbox_increments",
    """SELECT poll, outbox_id, key, value FROM (
       SELECT CASE WHEN event_id <= (SELECT count(*) // 2 FROM events) THEN 1 ELSE 2 END AS poll,
       event_id AS outbox_id, CAST(user_id AS VARCHAR) AS key,
       '{"event_type":"' || event_type || '","payload":' || to_json(props) || '}' AS value FROM events)""",
)
def outbox_increments(spark: SparkSession, folder: str) -> DataFrame:
    """Two polls of an outbox with a stored mark. Half of the rows are there at first; the
    first poll crashes between publishing and storing its mark and is repeated; the rest
    arrives before the second poll."""
    work = work_folder(spark, "outbox")
    events = table(spark, folder, "events").withColumnRenamed("props", "payload")
    half = events.count() // 2
    crashed = []

    def publish(rows: DataFrame, poll: int) -> None:
        messages = bounded.outbox_messages(rows, "event_id", "user_id", F.lit("orders.events"))
        messages.write.mode("overwrite").parquet(f"{work}/published/poll={poll}")
        if not crashed:
            crashed.append(poll)
            raise ConnectionError("lost after publishing")

    for arrived in (F.col("event_id") <= half, F.col("event_id") > half):
        events.filter(arrived).write.mode("append").parquet(f"{work}/outbox")
        outbox = spark.read.schema(events.schema).parquet(f"{work}/outbox")
        try:
            bounded.poll_outbox(outbox, "event_id", f"{work}/marks", publish)
        except ConnectionError:
            bounded.poll_outbox(outbox, "event_id", f"{work}/marks", publish)
    return spark.read.parquet(f"{work}/published").select("poll", "outbox_id", "key", "value")


@query("rows_total", "SELECT count(*) AS total_rows FROM events")
def rows_total(spark: SparkSession, folder: str) -> DataFrame:
    return counts.total_rows(inputs.cdc_log(table(spark, folder, "events")))


@query("rows_by_op", f"SELECT {_OP} AS op, count(*) AS n FROM events GROUP BY 1")
def rows_by_op(spark: SparkSession, folder: str) -> DataFrame:
    return counts.count_by_op(inputs.cdc_log(table(spark, folder, "events")))


@query(
    "newest_changes",
    f"""SELECT user_id AS order_id, {_OP} AS op, epoch_us(ts) // 1000 AS cdc_ts_ms, event_id AS "offset"
        FROM events ORDER BY cdc_ts_ms DESC, event_id LIMIT 10""",
)
def newest_changes(spark: SparkSession, folder: str) -> DataFrame:
    changes = inputs.cdc_log(table(spark, folder, "events"))
    return newest(changes.select("order_id", "op", "cdc_ts_ms", "offset"), "cdc_ts_ms", 10, "offset")


@query(
    "commit_history",
    "SELECT CAST(0 AS BIGINT) AS version, 'STREAMING UPDATE' AS operation, count(*) AS num_rows FROM events",
)
def commit_history(spark: SparkSession, folder: str) -> DataFrame:
    work = work_folder(spark, "history")
    changes = inputs.cdc_log(table_stream(spark, folder, "events"))
    sinks.append_with_history(
        changes, f"{work}/table", f"{work}/checkpoint", every=None
    ).awaitTermination()
    return sinks.history(spark, f"{work}/table").select("version", "operation", "num_rows")


_ONCE = f"SELECT {_OP} AS op, count(*) AS n_rows, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM events GROUP BY 1"


def _op_totals(rows: DataFrame) -> DataFrame:
    return rows.groupBy("op").agg(
        F.count("*").alias("n_rows"), F.sum("total_amount").cast("double").alias("total")
    )


@query("restarted_append", _ONCE)
def restarted_append(spark: SparkSession, folder: str) -> DataFrame:
    """The same append job run twice on one checkpoint: nothing is added twice."""
    work = work_folder(spark, "restarted")
    for _ in range(2):
        changes = inputs.cdc_log(table_stream(spark, folder, "events"))
        sinks.append_table(
            changes, f"{work}/table", f"{work}/checkpoint", every=None
        ).awaitTermination()
    return _op_totals(spark.read.parquet(f"{work}/table"))


@query("replayed_append", _ONCE)
def replayed_append(spark: SparkSession, folder: str) -> DataFrame:
    """A replay under a new name reads from the start into its own table."""
    work = work_folder(spark, "replayed")
    for name in ("orders", "orders-replay"):
        changes = inputs.cdc_log(table_stream(spark, folder, "events"))
        sinks.silver_table(changes, work, name, every=None).awaitTermination()
    return _op_totals(spark.read.parquet(f"{work}/orders-replay"))
