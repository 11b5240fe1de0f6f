"""Items of paid orders, with what waits for its partner kept in tables.

The same pairs as :func:`millrace.streaming.joins.paid_items`, for micro-batches of many
rows. A stream-stream join reads and writes entries of the state store for every row, and
searches all of them for old ones in every micro-batch. Here a micro-batch joins what
arrived with the stored rows of the batches before it, so it pays for a few batch joins.
``compact_every`` folds the rows that can still find a partner into a new base; rows that
the watermark has passed are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.streaming.joins import RESERVE_WITHIN_SECONDS
from millrace.streaming.sinks import FILE_TRIGGER, with_trigger
from millrace.streaming.windows import WATERMARK

#: One row for each batch: its newest base, the latest times seen and the watermark of the
#: next batch, in microseconds.
MARKS = "batch BIGINT, base BIGINT, created BIGINT, paid BIGINT, watermark BIGINT"
COMPACT_EVERY = 50


def paid_items_stream(
    created: DataFrame,
    payments: DataFrame,
    home: str,
    checkpoint: str,
    within_seconds: int = RESERVE_WITHIN_SECONDS,
    watermark: str = WATERMARK,
    every: str | None = FILE_TRIGGER,
    compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Keeps the table of ``order_id, paid_at, partition, offset, items`` below ``home``.

    ``created`` and ``payments`` are those of ``paid_items``, as are the results: either may
    arrive first, rows at or behind the watermark (the earlier of both sides' latest times, less
    the delay) are dropped, and of repeated payments that are less than the delay apart the
    earliest of its batch counts. Read with ``read_paid_items``.
    """
    spark = created.sparkSession
    delay = spark.range(1).select(F.expr(f"unix_micros(timestamp_micros(0) + INTERVAL '{watermark}')")).first()[0]
    kind = {f.name: f.dataType for f in (*created.schema, *payments.schema)}

    def none(name: str) -> Column:
        return F.lit(None).cast(kind[name]).alias(name)

    lefts = created.select(
        "order_id", F.col("created_at").alias("at"), "items", none("partition"), none("offset"), F.lit(False).alias("paid")
    )
    rights = payments.select(
        "order_id", F.col("paid_at").alias("at"), none("items"), "partition", "offset", F.lit(True).alias("paid")
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        fold = bool(compact_every) and batch_id % compact_every == compact_every - 1
        apply_batch(home, batch, batch_id, within_seconds * 1_000_000, delay, fold)

    writer = lefts.unionByName(rights).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def apply_batch(home: str, batch: DataFrame, batch_id: int, within: int, delay: int, fold: bool) -> None:
    """Joins a batch with itself and what waits, and stores its rows, pairs and mark.

    Times are in microseconds. A batch that runs again reads the batches before it only and
    replaces its own folders; it counts once its mark is there.
    """
    spark = batch.sparkSession
    mark = _mark(spark, home, batch_id - 1) if batch_id else None
    behind = mark["watermark"] if mark else None
    at = F.unix_micros("at")
    on_time = F.col("order_id").isNotNull() & F.col("at").isNotNull()
    if behind is not None:
        on_time = on_time & (at > behind)
    batch.filter(on_time).write.mode("overwrite").parquet(f"{home}/arrived/batch={batch_id}")
    arrived = spark.read.schema(batch.schema).parquet(f"{home}/arrived/batch={batch_id}")

    first = arrived.filter("paid").groupBy("order_id").agg(F.min(F.struct("at", "partition", "offset")).alias("p"))
    first = first.select("order_id", F.col("p.at").alias("paid_at"), "p.partition", "p.offset")
    earlier = _folders(mark, batch_id)
    orders = _created(arrived)
    if earlier:
        payments = spark.read.schema(first.schema).parquet(*[f"{home}/payments/{f}" for f in earlier])
        waiting = spark.read.schema(batch.schema).parquet(*[f"{home}/arrived/{f}" for f in earlier])
        known = _alive(payments, "paid_at", delay, behind)
        first = first.join(known.select("order_id"), "order_id", "left_anti")
        orders = orders.unionByName(_alive(_created(waiting), "created_at", within, behind))
    first.write.mode("overwrite").parquet(f"{home}/payments/batch={batch_id}")
    accepted = spark.read.schema(first.schema).parquet(f"{home}/payments/batch={batch_id}")

    pairs = _pairs(orders, accepted, within)
    if earlier:
        pairs = pairs.unionByName(_pairs(_created(arrived), _alive(payments, "paid_at", 0, behind), within))
    pairs.write.mode("overwrite").parquet(f"{home}/items/batch={batch_id}")

    new = arrived.agg(
        F.max(F.when(~F.col("paid"), at)).alias("created"), F.max(F.when(F.col("paid"), at)).alias("paid")
    ).first()
    latest = {
        side: max((t for t in (new[side], mark and mark[side]) if t is not None), default=None)
        for side in ("created", "paid")
    }
    if None not in latest.values():
        behind = min(latest.values()) - delay
    base = mark["base"] if mark else None
    if fold:
        kept = [f"batch={batch_id}", *earlier]
        waiting = spark.read.schema(batch.schema).parquet(*[f"{home}/arrived/{f}" for f in kept])
        waiting = _alive(waiting.filter("NOT paid"), "at", within, behind)
        waiting.write.mode("overwrite").parquet(f"{home}/arrived/base={batch_id}")
        payments = spark.read.schema(first.schema).parquet(*[f"{home}/payments/{f}" for f in kept])
        _alive(payments, "paid_at", delay, behind).write.mode("overwrite").parquet(f"{home}/payments/base={batch_id}")
        base = batch_id
    row = spark.createDataFrame([(batch_id, base, latest["created"], latest["paid"], behind)], MARKS)
    row.coalesce(1).write.mode("overwrite").parquet(f"{home}/marks/batch={batch_id}")


def read_paid_items(spark: SparkSession, home: str) -> DataFrame:
    """The pairs of all batches that have a mark."""
    marks = spark.read.schema(MARKS).parquet(f"{home}/marks/*").select("batch").collect()
    return spark.read.parquet(*[f"{home}/items/batch={m['batch']}" for m in marks])


def _mark(spark: SparkSession, home: str, batch_id: int):
    return spark.read.schema(MARKS).parquet(f"{home}/marks/batch={batch_id}").first()


def _folders(mark, batch_id: int) -> list[str]:
    """The newest base and the batches after it, up to but without ``batch_id``."""
    base = mark["base"] if mark else None
    batches = [f"batch={b}" for b in range(0 if base is None else base + 1, batch_id)]
    return batches + ([] if base is None else [f"base={base}"])


def _created(arrived: DataFrame) -> DataFrame:
    return arrived.filter("NOT paid").select("order_id", F.col("at").alias("created_at"), "items")


def _alive(rows: DataFrame, time: str, reach: int, behind: int | None) -> DataFrame:
    """Rows that the watermark has not passed ``reach`` microseconds after their time."""
    return rows if behind is None else rows.filter(F.unix_micros(time) > behind - reach)


def _pairs(orders: DataFrame, payments: DataFrame, within: int) -> DataFrame:
    after = F.unix_micros("paid_at") - F.unix_micros("created_at")
    return (
        orders.join(payments, "order_id")
        .filter(after.between(0, within))
        .select("order_id", "paid_at", "partition", "offset", "items")
    )
