"""Queries over duplicated and changing CDC rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import dedup as batch_dedup
from millrace.operators.latest import compacted, latest_per_key
from millrace.operators.upsert import current_rows, reduce_changes
from millrace.plans import inputs
from millrace.plans.inputs import table, table_stream
from millrace.plans.registry import drained, plain_times, query
from millrace.runtime import ROCKSDB_PROVIDER, work_folder
from millrace.streaming import dedup
from millrace.streaming.keyed import BUCKETS
from millrace.streaming.upsert import compact, read_current, read_state, upsert_stream

_OP = "CASE event_type WHEN 'signup' THEN 'c' WHEN 'view' THEN 'r' WHEN 'error' THEN 'd' ELSE 'u' END"
_LOG = f"""SELECT event_id AS "offset", user_id AS order_id, {_OP} AS op, epoch_us(ts) // 1000 AS cdc_ts_ms,
  event_type AS status, value AS total_amount, ts AS kafka_ts FROM events"""
_COLUMNS = ["offset", "order_id", "op", "cdc_ts_ms", "status", "total_amount", "kafka_ts"]


def duplicated(events: DataFrame) -> DataFrame:
    """Every tenth event is delivered twice."""
    copies = F.when(F.col("event_id") % 10 == 0, 2).otherwise(1)
    return events.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")


def _shown(df: DataFrame) -> DataFrame:
    return plain_times(
        df.select(*_COLUMNS).withColumn("total_amount", F.col("total_amount").cast("double"))
    )


@query("cdc_versions", _LOG)
def cdc_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Stream: identical re-emissions collapse, distinct versions stay."""
    changes = inputs.cdc_log(duplicated(table_stream(spark, folder, "events")))
    return _shown(drained(dedup.cdc_versions(changes), "versions"))


@query("cdc_versions_thinned", _LOG)
def cdc_versions_thinned(spark: SparkSession, folder: str) -> DataFrame:
    """The same with copies dropped before the shuffle."""
    changes = inputs.cdc_log(duplicated(table_stream(spark, folder, "events")))
    return _shown(drained(dedup.cdc_versions(changes, thin=True), "thinned"))


@query("cdc_versions_within_watermark", _LOG)
def cdc_versions_within_watermark(spark: SparkSession, folder: str) -> DataFrame:
    changes = inputs.cdc_log(duplicated(table_stream(spark, folder, "events")))
    once = dedup.once_within_watermark(changes, ["order_id", "cdc_ts_ms"], "kafka_ts")
    return _shown(drained(once, "within"))


@query("cdc_versions_custom_state", _LOG)
def cdc_versions_custom_state(spark: SparkSession, folder: str) -> DataFrame:
    """Custom state with a time to live, keyed by order and update time."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    changes = inputs.cdc_log(duplicated(table_stream(spark, folder, "events")))
    once = dedup.first_with_ttl(changes, ["order_id", "kafka_ts"], ttl_ms=3_600_000, buckets=BUCKETS)
    # State with processing-time expiry asks for one more batch for ever; a run that
    # is to stop must not be given batches without data.
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        return _shown(drained(once, "custom"))
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


@query("cdc_versions_stored", _LOG)
def cdc_versions_stored(spark: SparkSession, folder: str) -> DataFrame:
    changes = inputs.cdc_log(duplicated(table(spark, folder, "events")))
    return _shown(batch_dedup.distinct_versions(changes))


@query(
    "events_once",
    """SELECT 'e-' || event_id AS event_id, user_id AS order_id, event_id AS "offset", ts AS occurred_at FROM events""",
)
def events_once(spark: SparkSession, folder: str) -> DataFrame:
    """Each event id once, however often it was delivered."""
    delivered = duplicated(table(spark, folder, "events")).select(
        F.concat(F.lit("e-"), "event_id").alias("event_id"),
        F.col("user_id").alias("order_id"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("occurred_at"),
    )
    return batch_dedup.once_per_event(delivered).drop("partition")


@query(
    "first_charges",
    """SELECT user_id AS order_id, min(event_id) AS "offset", arg_min(value, event_id) AS amount
       FROM events WHERE event_type = 'purchase' GROUP BY 1""",
)
def first_charges(spark: SparkSession, folder: str) -> DataFrame:
    """One charge per order: its first."""
    charges = table(spark, folder, "events").filter("event_type = 'purchase'").select(
        F.col("user_id").alias("order_id"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("value").alias("amount"),
    )
    return batch_dedup.first_per_key(charges, ["order_id"]).drop("partition")


_LATEST = f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
  ORDER BY cdc_ts_ms DESC, "offset" DESC) AS rn FROM ({_LOG})) WHERE rn = 1"""


@query("latest_change_per_order", _LATEST)
def latest_change_per_order(spark: SparkSession, folder: str) -> DataFrame:
    changes = inputs.cdc_log(table(spark, folder, "events"))
    return _shown(latest_per_key(changes, ["order_id"], ["cdc_ts_ms", "offset"]))


@query(
    "compacted_log",
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY order_id
        ORDER BY "offset" DESC) AS rn FROM ({_LOG})) WHERE rn = 1""",
)
def compacted_log(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(compacted(inputs.cdc_log(table(spark, folder, "events")), ["order_id"]))


@query("current_orders", f"SELECT * FROM ({_LATEST}) WHERE op <> 'd'")
def current_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Change stream merged into a current-state table, compacted and read back."""
    work = work_folder(spark, "current")
    changes = inputs.cdc_log(duplicated(table_stream(spark, folder, "events")))
    upsert_stream(
        changes, f"{work}/orders", f"{work}/checkpoint", ["order_id"], every=None
    ).awaitTermination()
    compact(spark, f"{work}/orders", ["order_id"])
    return _shown(read_current(spark, f"{work}/orders", ["order_id"]))


@query("current_orders_stored", f"SELECT * FROM ({_LATEST}) WHERE op <> 'd'")
def current_orders_stored(spark: SparkSession, folder: str) -> DataFrame:
    changes = inputs.cdc_log(table(spark, folder, "events"))
    return _shown(current_rows(reduce_changes(changes, ["order_id"])))


@query("orders_state", _LATEST)
def orders_state(spark: SparkSession, folder: str) -> DataFrame:
    """Latest state per order without deletes; a second run applies nothing twice."""
    work = work_folder(spark, "state")
    for _ in range(2):
        changes = inputs.cdc_log(table_stream(spark, folder, "events"))
        upsert_stream(
            changes, f"{work}/orders", f"{work}/checkpoint", ["order_id"], every=None
        ).awaitTermination()
    return _shown(read_state(spark, f"{work}/orders", ["order_id"]))
