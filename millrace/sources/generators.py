"""Generated orders and payments for demonstrations and tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _order_columns(i: Column, created_at: Column, variant: str) -> list[Column]:
    # The two order shapes.
    if variant == "padded":
        customer = F.concat(F.lit("cust-"), F.lpad((i % 5).cast("string"), 3, "0"))
        total = F.round(F.lit(10.0) + F.lit(3.5) * i, 2)
    elif variant == "plain":
        customer = F.concat(F.lit("customer-"), (i % 5).cast("string"))
        total = i * F.lit(9.99)
    else:
        raise ValueError(f"unknown order variant: {variant}")
    return [
        F.concat(F.lit("order-"), i.cast("string")).alias("id"),
        customer.alias("customer_id"),
        total.alias("total"),
        F.lit("EUR").alias("currency"),
        created_at.alias("created_at"),
    ]


def orders(
    spark: SparkSession, n: int, variant: str = "padded", now: datetime | None = None
) -> DataFrame:
    stamp = F.current_timestamp() if now is None else F.lit(now)
    return spark.range(n).select(*_order_columns(F.col("id"), stamp, variant))


def order_stream(spark: SparkSession, per_second: int, variant: str = "padded") -> DataFrame:
    rows = spark.readStream.format("rate").option("rowsPerSecond", per_second).load()
    return rows.select(*_order_columns(F.col("value"), F.col("timestamp"), variant))


def payments(orders_df: DataFrame, delay_seconds: Column | int = 60) -> DataFrame:
    """One payment per order, the given delay after it."""
    method = F.element_at(
        F.array(F.lit("card"), F.lit("paypal"), F.lit("transfer")),
        (F.pmod(F.xxhash64("id"), F.lit(3)) + 1).cast("int"),
    )
    return orders_df.select(
        F.concat(F.lit("pay-"), "id").alias("payment_id"),
        F.col("id").alias("order_id"),
        F.col("total").alias("amount"),
        "currency",
        method.alias("method"),
        F.timestamp_add("SECOND", F.lit(delay_seconds), F.col("created_at")).alias("paid_at"),
    )
