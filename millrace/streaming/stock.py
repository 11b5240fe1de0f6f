"""Stock reservation on a stream of orders, with standing balances.

Every micro-batch is decided by :func:`millrace.operators.stock.reserve` against what
earlier batches left, so history is never replayed. What is kept are movements: a row for
each SKU that an order took or gave back. ``compact`` folds them into one row per SKU,
plus the lines of orders that still hold their stock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.stock import RELEASE, REQUEST, movements, reserve
from millrace.runtime import stored
from millrace.streaming.sinks import FILE_TRIGGER, history, record_commit, with_trigger

APPLIED = "RESERVE"
COMPACTED = "COMPACT"
COMPACT_EVERY = 50
_PLACE = ["at", "partition", "offset"]


def _versions(spark: SparkSession, ledger: str, before: int) -> list[str]:
    """Folders of the newest base and of the batches after it, up to but without ``before``."""
    rows = history(spark, ledger).filter(F.col("version").between(0, before - 1))
    kinds = {r["version"]: set() for r in rows.select("version").collect()}
    for r in rows.select("version", "operation").collect():
        kinds[r["version"]].add(r["operation"])
    base = max((v for v, k in kinds.items() if COMPACTED in k), default=None)
    batches = [v for v, k in kinds.items() if APPLIED in k and (base is None or v > base)]
    return [f"{ledger}/moved/batch={v}" for v in sorted(batches)] + (
        [f"{ledger}/moved/base={base}"] if base is not None else []
    )


def open_ledger(ledger: str, stock: DataFrame) -> None:
    """Stores the opening stock, ``sku`` and ``quantity``."""
    opening = stock.select("sku", F.col("quantity").cast("bigint").alias("quantity"))
    opening.write.mode("overwrite").parquet(f"{ledger}/opening")
    record_commit(stock.sparkSession, ledger, -1, "OPEN", 0)


def apply_batch(ledger: str, batch: DataFrame, batch_id: int) -> None:
    """Decides the requests of a batch and stores its decisions and movements.

    ``batch``: order_id, kind (``request`` or ``release``), at, partition, offset and, for
    requests, items of ``sku, quantity``. Batches come in the order of their places. A
    batch that runs again reads the batches before it only and replaces its own rows.
    """
    spark = batch.sparkSession
    batch = stored(batch, "stock-batch")
    requests = batch.filter(F.col("kind") == REQUEST).select(
        "order_id", *_PLACE, F.posexplode("items").alias("line_no", "item")
    )
    demands = requests.select("order_id", *_PLACE, "line_no", "item.sku", "item.quantity")
    releases = batch.filter(F.col("kind") == RELEASE).select("order_id", *_PLACE)
    balances = spark.read.parquet(f"{ledger}/opening")
    returned = None
    earlier = _versions(spark, ledger, batch_id)
    if earlier:
        moved = spark.read.parquet(*earlier)
        held = (
            moved.join(releases.select("order_id").distinct(), "order_id", "left_semi")
            .groupBy("order_id", "sku")
            .agg(F.sum("quantity").alias("quantity"))
            .filter("quantity > 0")
        )
        first = releases.groupBy("order_id").agg(F.min(F.struct(*_PLACE)).alias("p")).select("order_id", "p.*")
        returned = stored(held.join(first, "order_id"), "stock-returned")
        touched = demands.select("sku").union(returned.select("sku")).distinct()
        taken = moved.join(touched, "sku", "left_semi").groupBy("sku").agg(F.sum("quantity").alias("_taken"))
        balances = (
            balances.join(touched, "sku", "left_semi")
            .join(taken, "sku", "left")
            .select("sku", (F.col("quantity") - F.coalesce("_taken", F.lit(0))).alias("quantity"))
        )
    decided = stored(reserve(demands, balances, releases, returned=returned), "stock-decided")
    decided.write.mode("overwrite").parquet(f"{ledger}/decisions/batch={batch_id}")
    moves = movements(demands, releases, decided, returned)
    moves.write.mode("overwrite").parquet(f"{ledger}/moved/batch={batch_id}")
    record_commit(spark, ledger, batch_id, APPLIED, decided.count())


def compact(spark: SparkSession, ledger: str, upto: int, ended: DataFrame | None = None) -> None:
    """Folds all movements up to a batch into balances and the lines still held.

    ``ended``: order_ids that can give nothing back any more, such as shipped orders.
    """
    moved = spark.read.parquet(*_versions(spark, ledger, upto + 1))
    lines = moved.groupBy("order_id", "sku").agg(F.sum("quantity").alias("quantity"))
    keeps = F.col("order_id").isNotNull()
    if ended is not None:
        gone = ended.select(F.col("order_id").alias("_id"), F.lit(True).alias("_ended")).distinct()
        lines = lines.join(gone, F.col("order_id") == F.col("_id"), "left")
        keeps = keeps & F.col("_ended").isNull()
    lines = lines.select(F.when(keeps, F.col("order_id")).alias("order_id"), "sku", "quantity")
    folded = lines.groupBy("order_id", "sku").agg(F.sum("quantity").alias("quantity")).filter("quantity <> 0")
    folded.write.mode("overwrite").parquet(f"{ledger}/moved/base={upto}")
    record_commit(spark, ledger, upto, COMPACTED, 0)


def balances(spark: SparkSession, ledger: str) -> DataFrame:
    """What is left of each SKU after all batches."""
    left = spark.read.parquet(f"{ledger}/opening")
    paths = _versions(spark, ledger, 1 << 62)
    if not paths:
        return left
    taken = spark.read.parquet(*paths).groupBy("sku").agg(F.sum("quantity").alias("_taken"))
    return left.join(taken, "sku", "left").select(
        "sku", (F.col("quantity") - F.coalesce("_taken", F.lit(0))).alias("quantity")
    )


def decisions(spark: SparkSession, ledger: str) -> DataFrame:
    """Outcomes of all committed batches."""
    rows = history(spark, ledger).filter(F.col("operation") == APPLIED).select("version").collect()
    return spark.read.parquet(*[f"{ledger}/decisions/batch={r['version']}" for r in rows])


def reserve_stream(
    entries: DataFrame,
    ledger: str,
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
    compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Applies a stream of requests and releases to an open ledger."""

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_batch(ledger, batch, batch_id)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(batch.sparkSession, ledger, batch_id)

    writer = entries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()
