"""Event-time windows. The same functions serve streams and stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.shaping import flatten_window
from millrace.operators.running import Running, running, time_chunk
from millrace.schemas import MONEY

# Watermark and window lengths of the silver tables.
WATERMARK = "10 minutes"
TUMBLING = "1 minute"
SLIDING = ("5 minutes", "1 minute")
SESSION_GAP = "30 minutes"
DEMO_WINDOW = "30 seconds"
DEMO_WATERMARK = "1 minute"


def _watermarked(df: DataFrame, ts: str, delay: str) -> DataFrame:
    return df.withWatermark(ts, delay) if df.isStreaming else df


def revenue_by_window(
    orders: DataFrame,
    ts: str = "kafka_ts",
    by: str = "status",
    amount: str = "total_amount",
    length: str = TUMBLING,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Orders and revenue per tumbling window. Money is summed as decimal."""
    counted = (
        _watermarked(orders, ts, watermark)
        .groupBy(F.window(ts, length), by)
        .agg(
            F.count("*").alias("orders_count"),
            F.sum(F.col(amount).cast(MONEY)).alias("revenue"),
        )
    )
    return flatten_window(counted)


def basket_by_window(
    orders: DataFrame,
    ts: str = "kafka_ts",
    by: str = "status",
    amount: str = "total_amount",
    length: str = SLIDING[0],
    slide: str = SLIDING[1],
    watermark: str = WATERMARK,
) -> DataFrame:
    """Mean basket per sliding window.

    A row falls into length/slide windows. It is counted once per slide first; the
    windows then add up those counts, so the rows themselves are never multiplied.
    A stream has to do it in one step, whose partial aggregation has the same effect.
    """
    total = F.sum(F.col(amount).cast(MONEY))
    if orders.isStreaming:
        counted = (
            _watermarked(orders, ts, watermark)
            .groupBy(F.window(ts, length, slide), by)
            .agg(total.alias("_total"), F.count("*").alias("orders_count"))
        )
    else:
        slides = orders.groupBy(F.window(ts, slide).alias("_slide"), by).agg(
            total.alias("_total"), F.count("*").alias("_count")
        )
        counted = slides.groupBy(
            F.window(F.col("_slide.start"), length, slide), by
        ).agg(F.sum("_total").alias("_total"), F.sum("_count").alias("orders_count"))
    mean = F.col("_total").cast("double") / F.col("orders_count")
    return flatten_window(counted.select("window", by, mean.alias("avg_basket"), "orders_count"))


def sessions(
    events: DataFrame,
    key: str = "customer_id",
    ts: str = "kafka_ts",
    gap: str = SESSION_GAP,
    watermark: str = WATERMARK,
    amount: str | None = None,
) -> DataFrame:
    """Activity sessions per key, closed by more than a gap without a row.

    A stream uses Spark's session windows. Over a stored table those would bring all
    rows of a key to one task, so there the start of the session is carried along in
    chunks and the sessions are summed up by an aggregate with a partial step.
    """
    if not events.isStreaming:
        return _stored_sessions(events, key, ts, gap, amount)
    measures = [F.count("*").alias("n_events")]
    if amount:
        measures.append(F.sum(F.col(amount).cast(MONEY)).alias("amount"))
    counted = (
        _watermarked(events, ts, watermark)
        .groupBy(F.session_window(ts, gap).alias("window"), key)
        .agg(*measures)
    )
    return flatten_window(counted)


def _stored_sessions(
    events: DataFrame, key: str, ts: str, gap: str, amount: str | None
) -> DataFrame:
    measures = {"n_events": F.count("*")}
    if amount:
        measures["amount"] = F.sum(F.col(amount).cast(MONEY))
    moments = events.groupBy(key, F.col(ts).alias("_ts")).agg(
        *[value.alias(name) for name, value in measures.items()]
    )
    length = F.expr(f"INTERVAL {gap}")
    chunk = time_chunk(F.col("_ts"))
    lagged = running(moments, [key], ["_ts"], chunk, Running(lags={"_before": F.col("_ts")}))
    fresh = F.col("_before").isNull() | (F.col("_ts") > F.col("_before") + length)
    started = running(
        lagged, [key], ["_ts"], chunk,
        Running(lasts={"window_start": F.when(fresh, F.col("_ts"))}),
    )
    return started.groupBy(key, "window_start").agg(
        (F.max("_ts") + length).alias("window_end"),
        *[F.sum(name).cast("bigint" if name == "n_events" else MONEY).alias(name) for name in measures],
    ).select("window_start", "window_end", key, *measures)


def counts_by_window(
    events: DataFrame,
    ts: str = "kafka_ts",
    length: str = DEMO_WINDOW,
    watermark: str = DEMO_WATERMARK,
    by: list[str | Column] | None = None,
) -> DataFrame:
    """Rows per short window under a short watermark, to watch late rows being dropped."""
    counted = (
        _watermarked(events, ts, watermark)
        .groupBy(F.window(ts, length), *(by or []))
        .agg(F.count("*").alias("n_events"))
    )
    return flatten_window(counted)
