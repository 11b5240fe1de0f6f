"""Current-state tables maintained by a stream.

A micro-batch is reduced to one change per key and stored as one version; readers
reduce the versions again. That writes only what changed, whereas rewriting the
state would cost its full size per micro-batch. ``compact`` folds the versions into
a new base now and then, so that reads stay cheap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.upsert import NEWEST_BY, current_rows, merge_changes, reduce_changes
from millrace.streaming.sinks import FILE_TRIGGER, history, record_commit, with_trigger

MERGE = "MERGE"
COMPACT = "COMPACT"
COMPACT_EVERY = 100


def upsert_stream(
    changes: DataFrame,
    table: str,
    checkpoint: str,
    keys: list[str],
    newest_by: tuple[str, ...] = NEWEST_BY,
    every: str | None = FILE_TRIGGER,
    output_mode: str = "append",
    compact_every: int | None = COMPACT_EVERY,
) -> StreamingQuery:
    """Applies a stream of changes. A batch that runs again replaces its own version.

    ``output_mode='update'`` serves aggregates whose rows are emitted repeatedly. Every
    ``compact_every``-th batch folds all versions into a new base, so that readers have
    a bounded number of versions to merge.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = f"{table}/version={batch_id}"
        reduced = reduce_changes(batch, keys, newest_by)
        reduced.write.mode("overwrite").parquet(folder)
        n = session.read.schema(reduced.schema).parquet(folder).count()
        record_commit(session, table, batch_id, MERGE, n)
        if compact_every and batch_id % compact_every == compact_every - 1:
            compact(session, table, keys, newest_by)

    writer = (
        changes.writeStream.foreachBatch(apply)
        .outputMode(output_mode)
        .option("checkpointLocation", checkpoint)
    )
    return with_trigger(writer, every).start()


def _committed(spark: SparkSession, table: str, upto: int | None) -> tuple[int | None, list[int]]:
    """Newest usable base and the versions after it, as the history tells."""
    rows = history(spark, table)
    if upto is not None:
        rows = rows.filter(F.col("version") <= upto)
    base = rows.filter(F.col("operation") == COMPACT).agg(F.max("version")).first()[0]
    merges = rows.filter(F.col("operation") == MERGE)
    if base is not None:
        merges = merges.filter(F.col("version") > base)
    return base, [r["version"] for r in merges.select("version").collect()]


def read_state(
    spark: SparkSession,
    table: str,
    keys: list[str],
    newest_by: tuple[str, ...] = NEWEST_BY,
    version: int | None = None,
) -> DataFrame:
    """State with its deletion marks, as of a version or now."""
    base, versions = _committed(spark, table, version)
    paths = [f"{table}/version={v}" for v in versions]
    if base is not None:
        paths.append(f"{table}/base={base}")
    merged = spark.read.option("mergeSchema", "true").parquet(*paths)
    return merge_changes(None, merged, keys, newest_by)


def read_current(spark: SparkSession, table: str, keys: list[str], **options) -> DataFrame:
    return current_rows(read_state(spark, table, keys, **options))


def compact(
    spark: SparkSession, table: str, keys: list[str], newest_by: tuple[str, ...] = NEWEST_BY
) -> int:
    """Writes the present state as a base for later reads; returns its version.

    A base that is still current is left alone, as readers may be using it.
    """
    merges = history(spark, table).filter(F.col("operation") == MERGE)
    last = merges.agg(F.max("version")).first()[0]
    if _committed(spark, table, None)[0] == last:
        return last
    state = read_state(spark, table, keys, newest_by, version=last)
    folder = f"{table}/base={last}"
    state.write.mode("overwrite").parquet(folder)
    n = spark.read.schema(state.schema).parquet(folder).count()
    record_commit(spark, table, last, COMPACT, n)
    return last
