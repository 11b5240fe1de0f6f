"""Logical inputs built from the stored tables: the change feed, the event log, raw
lines, messages and metric samples that the registered queries run on."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import framing
from millrace.operators.running import OFFSETS_PER_CHUNK, Running, numbered, offset_chunk, running
from millrace.schemas import MONEY
from millrace.sources.envelope import file_stream

SCHEMA_ID = 7
RESTART_EVERY = 500

# Makes raw lines out of events, broken in a way that follows from the event id.
RAW_LINE = """
CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 11 = 0 THEN '[1]' WHEN event_id % 7 = 0 THEN '{bad'
  ELSE concat('{"order_id":"', event_id, '","customer_id":',
              CASE WHEN event_id % 5 = 0 THEN 'null' ELSE concat('"', user_id, '"') END, ',"amount":',
              CASE WHEN event_id % 3 = 0 THEN '"unknown"' ELSE concat('', event_id % 100) END,
              ',"currency":"EUR","created_at":"2024-01-01T00:00:00Z"}') END
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = table(spark, folder, name).schema
    return file_stream(spark, f"{folder}/{name}.parquet", schema)


def arriving(df: DataFrame, batch: Column, n: int, path: str) -> Iterator[DataFrame]:
    """Adds the rows of batch 0, 1, ... to a folder, one batch at each step, and gives the
    stream over the folder every time. A query that runs to the end of what is there at
    each step so sees the batches one after the other."""
    numbered_rows = df.withColumn("_batch", batch)
    for i in range(n):
        part = numbered_rows.filter(F.col("_batch") == i).drop("_batch")
        part.write.mode("append").parquet(path)
        yield file_stream(df.sparkSession, path, df.schema)


def _cased(key: str, cases: dict[str, str], default: str | None = None) -> Column:
    chosen = None
    for name, value in cases.items():
        hit = F.col(key) == name
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen if default is None else chosen.otherwise(default)


def raw_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").select("event_id", F.expr(RAW_LINE).alias("line"))


def cdc_log(events: DataFrame) -> DataFrame:
    """Change feed: one change of order ``user_id`` per event."""
    ts = F.col("ts").cast("timestamp")
    return events.select(
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("user_id").alias("order_id"),
        _cased("event_type", {"signup": "c", "view": "r", "error": "d"}, "u").alias("op"),
        F.unix_millis(ts).alias("cdc_ts_ms"),
        F.col("event_type").alias("status"),
        F.col("value").cast(MONEY).alias("total_amount"),
        ts.alias("kafka_ts"),
    )


def orders_stream(events: DataFrame) -> DataFrame:
    """Events seen as orders with a status and an amount."""
    return events.select(
        F.col("ts").cast("timestamp").alias("kafka_ts"),
        F.col("event_type").alias("status"),
        F.col("value").alias("total_amount"),
        F.col("user_id").alias("customer_id"),
        F.col("event_id").alias("order_id"),
    )


def of_type(events: DataFrame, kind: str, amount: str) -> DataFrame:
    """Events of one type keyed by user: views act as orders, purchases as payments."""
    return events.filter(F.col("event_type") == kind).select(
        F.col("user_id").alias("order_id"),
        F.col("event_id").alias("customer_id"),
        F.col("value").cast(MONEY).alias(amount),
        F.col("ts").cast("timestamp").alias("kafka_ts"),
    )


def customers_dimension(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Customers with a contact name and their country."""
    return customer.join(
        nation, customer["c_nationkey"] == nation["n_nationkey"], "left"
    ).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("email"),
        F.col("n_name").alias("country"),
    )


def order_events(events: DataFrame, offsets_per_chunk: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """Event log keyed by user, versions counted along the offsets."""
    log = events.select(
        F.concat(F.lit("e-"), "event_id").alias("event_id"),
        F.col("user_id").alias("order_id"),
        F.col("ts").cast("timestamp").alias("occurred_at"),
        _cased(
            "event_type",
            {
                "signup": "OrderCreated",
                "purchase": "PaymentCompleted",
                "view": "StockReserved",
                "click": "OrderShipped",
                "error": "OrderCancelled",
            },
        ).alias("event_type"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        "value",
    )
    versioned = numbered(
        log, ["order_id"], ["offset"], offset_chunk(F.col("offset"), offsets_per_chunk)
    )

    def of(kind: str, value: Column) -> Column:
        return F.when(F.col("event_type") == kind, value)

    number = F.col("offset")
    return versioned.select(
        "event_id",
        "order_id",
        "occurred_at",
        F.col("version").cast("int").alias("version"),
        "event_type",
        "partition",
        "offset",
        of("OrderCreated", F.concat(F.lit("c-"), number)).alias("customer_id"),
        of("OrderCreated", F.col("value")).alias("total"),
        of("OrderCreated", F.lit("EUR")).alias("currency"),
        of("PaymentCompleted", F.concat(F.lit("t-"), number)).alias("transaction_id"),
        of("PaymentCompleted", F.col("value")).alias("amount"),
        of("StockReserved", F.concat(F.lit("r-"), number)).alias("reservation_id"),
        of("OrderShipped", F.concat(F.lit("TRK-"), number)).alias("tracking_number"),
        of("OrderCancelled", F.concat(F.lit("x-"), number)).alias("reason"),
    )


def messages(events: DataFrame) -> DataFrame:
    """Framed CDC messages, some of them broken in each way a frame or its text can be."""
    event_id = F.col("event_id")
    broken = (
        F.when(event_id % 2 == 0, '{"order_id"')
        .when(event_id % 3 == 0, '{"order_id":5,"total_amount":"abc"}')
        .when(event_id % 5 == 0, '{"order_id":7} trailing')
        .otherwise('{"status":"no order"}')
    )
    document = F.to_json(
        F.struct(
            F.col("user_id").cast("int").alias("order_id"),
            event_id.cast("int").alias("customer_id"),
            F.col("event_type").alias("status"),
            F.col("value").alias("total_amount"),
            F.lit("EUR").alias("currency"),
            _cased("event_type", {"signup": "c", "view": "r", "error": "d"}, "u").alias("__op"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("__source_ts_ms"),
        )
    )
    framed = framing.add_frame(document, SCHEMA_ID)
    value = (
        F.when(event_id % 19 == 0, F.lit(None).cast("binary"))
        .when(event_id % 17 == 0, F.lit(bytes(4)))
        .when(event_id % 13 == 0, framing.add_frame(F.lit(""), SCHEMA_ID))
        .when(event_id % 11 == 0, F.encode(document, "UTF-8"))
        .when(event_id % 7 == 0, framing.add_frame(broken, SCHEMA_ID))
        .otherwise(framed)
    )
    return events.select(
        F.encode(F.col("user_id").cast("string"), "UTF-8").alias("key"),
        value.alias("value"),
        F.concat(F.lit("shop.public."), "event_type").alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        event_id.alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def order_lines(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
    )


def counter_samples(events: DataFrame, offsets_per_chunk: int = OFFSETS_PER_CHUNK) -> DataFrame:
    """A counter per event type that adds up values and restarts every 500 samples."""
    place = events.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_type").alias("topic"),
        F.col("value").cast(MONEY).alias("amount"),
    )
    chunk = offset_chunk(F.col("event_id"), offsets_per_chunk)
    counted = numbered(place, ["topic"], ["event_id"], chunk, "n")
    life = counted.withColumn("life", F.floor((F.col("n") - 1) / RESTART_EVERY))
    summed = running(
        life, ["topic", "life"], ["event_id"], chunk, Running(sums={"value": F.col("amount")})
    )
    return summed.select(
        "ts",
        F.lit("messages_total").alias("metric"),
        F.create_map(F.lit("topic"), "topic", F.lit("instance"), F.lit("a")).alias("labels"),
        "value",
    )


def gauge_samples(events: DataFrame) -> DataFrame:
    """One gauge sample per event; series are event type and user modulo three."""
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("lag").alias("metric"),
        F.create_map(
            F.lit("topic"), F.col("event_type"),
            F.lit("partition"), (F.col("user_id") % 3).cast("string"),
            F.lit("consumergroup"), F.concat(F.lit("g"), F.col("user_id") % 5),
        ).alias("labels"),
        F.col("value").cast(MONEY).alias("value"),
    )


def end_offsets(events: DataFrame) -> DataFrame:
    return events.groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition")
    ).agg(F.count("*").alias("end_offset"))


def committed_offsets(events: DataFrame, cut_off: str = "2024-01-20") -> DataFrame:
    """What two groups have read: one up to the cut-off, one only half of the types."""
    per = events.groupBy(
        F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition")
    ).agg(
        F.count_if(F.col("ts") < F.lit(cut_off).cast("timestamp_ntz")).alias("early"),
        F.count("*").alias("every"),
    )
    return per.select(
        "topic",
        "partition",
        F.explode(
            F.array(
                F.struct(F.lit("billing").alias("g"), F.col("early").alias("o")),
                F.struct(F.lit("audit").alias("g"), (F.col("every") - F.col("partition")).alias("o")),
            )
        ).alias("_c"),
    ).select(
        F.col("_c.g").alias("consumergroup"), "topic", "partition",
        F.col("_c.o").alias("committed_offset"),
    )
