"""Stream joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.shaping import delay_seconds
from millrace.operators.joins import enriched, interval_join
from millrace.streaming.windows import WATERMARK

# A payment counts up to 15 minutes after its order.
PAYMENT_WINDOW_SECONDS = 15 * 60
#: How long after its creation the first payment of an order still reserves its items.
RESERVE_WITHIN_SECONDS = 24 * 3600
ENRICHED_COLUMNS = [
    "order_id", "customer_id", "email", "country", "status", "total_amount", "kafka_ts",
]


def orders_enriched(
    orders: DataFrame, customers: DataFrame, watermark: str = WATERMARK
) -> DataFrame:
    """Orders with the customer's email and country; unknown customers stay null.

    The watermark is set before the join and carried through it.
    """
    if orders.isStreaming:
        orders = orders.withWatermark("kafka_ts", watermark)
    return enriched(orders, customers, "customer_id", ENRICHED_COLUMNS)


def orders_with_payments(
    orders: DataFrame,
    payments: DataFrame,
    key: str = "order_id",
    within_seconds: int = PAYMENT_WINDOW_SECONDS,
    how: str = "inner",
    watermark: str = WATERMARK,
) -> DataFrame:
    """Orders and the payments that follow within the interval, both ends included.

    ``how='left_outer'`` adds orders without one, once the interval has passed. Both
    sides always get a watermark, as without it the state would only grow.

    Expects ``key, customer_id, total_amount, kafka_ts`` and ``key, amount, kafka_ts``.
    """
    lefts = orders.select(
        key,
        "customer_id",
        F.col("total_amount").alias("order_amount"),
        F.col("kafka_ts").alias("order_ts"),
    )
    rights = payments.select(
        key, F.col("amount").alias("payment_amount"), F.col("kafka_ts").alias("payment_ts")
    )
    if orders.isStreaming:
        lefts = lefts.withWatermark("order_ts", watermark)
        rights = rights.withWatermark("payment_ts", watermark)
    joined = interval_join(lefts, rights, key, "order_ts", "payment_ts", within_seconds, how)
    return joined.withColumn(
        "delay_seconds", delay_seconds(F.col("payment_ts"), F.col("order_ts"))
    )


def paid_items(
    created: DataFrame,
    payments: DataFrame,
    within_seconds: int = RESERVE_WITHIN_SECONDS,
    watermark: str = WATERMARK,
) -> DataFrame:
    """``order_id, paid_at, partition, offset, items``: what each paid order reserves.

    ``created``: order_id, items, created_at; ``payments``: order_id, paid_at, partition,
    offset. Either may arrive first; a stream keeps it until the watermark has passed the
    interval, so orders that nobody pays leave the state. Of repeated payments that are
    less than the watermark delay apart one counts. For micro-batches of many rows see
    ``paid.paid_items_stream``.
    """
    lefts = created.select("order_id", "items", "created_at")
    rights = payments.select("order_id", "paid_at", "partition", "offset")
    if created.isStreaming:
        lefts = lefts.withWatermark("created_at", watermark)
        rights = rights.withWatermark("paid_at", watermark)
        rights = rights.dropDuplicatesWithinWatermark(["order_id"])
    joined = interval_join(lefts, rights, "order_id", "created_at", "paid_at", within_seconds)
    return joined.select("order_id", "paid_at", "partition", "offset", "items")
