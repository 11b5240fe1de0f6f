"""Sinks of streaming queries. Each job owns a target and a checkpoint; running the
same job under a new pair of folders reprocesses the source from its start."""

from __future__ import annotations

import threading
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.readwriter import DataStreamWriter

from millrace.functions.shaping import json_messages, time_partitions
from millrace.schemas import HISTORY

# Trigger intervals of the file and the topic sink.
FILE_TRIGGER = "30 seconds"
TOPIC_TRIGGER = "5 seconds"


ROWS_PER_FILE = 5_000_000
#: Folders of several files whose names are broadcast; beyond, they are joined by shuffle.
BUSY_TO_BROADCAST = 100_000


def with_trigger(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Fixed interval, or (None) everything available now and then stop.

    Both use the same checkpoint, so a job may change from one to the other.
    """
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def append_table(
    df: DataFrame,
    target: str,
    checkpoint: str,
    every: str | None = FILE_TRIGGER,
    partition_by: tuple[str, ...] = (),
    name: str | None = None,
    table_format: str = "parquet",
) -> StreamingQuery:
    """Append-only table; files of a failed attempt are never read as part of it."""
    writer = (
        df.writeStream.format(table_format)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if table_format == "delta":
        writer = writer.option("mergeSchema", "true")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if name:
        writer = writer.queryName(name)
    return with_trigger(writer, every).start(target)


def silver_table(
    df: DataFrame, root: str, name: str, every: str | None = FILE_TRIGGER
) -> StreamingQuery:
    """Append table ``<root>/<name>`` with its checkpoint below the same root."""
    return append_table(df, f"{root}/{name}", f"{root}/_checkpoints/{name}", every)


def republish_json(
    df: DataFrame,
    key: str,
    checkpoint: str,
    every: str | None = TOPIC_TRIGGER,
    name: str | None = None,
    topic: str | None = None,
    servers: str | None = None,
    folder: str | None = None,
) -> StreamingQuery:
    """Rows as keyed JSON messages, to a topic or to a folder of the same two columns."""
    writer = (
        json_messages(df, key)
        .writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
    )
    if name:
        writer = writer.queryName(name)
    if topic:
        writer = (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
        )
        return with_trigger(writer, every).start()
    return with_trigger(writer.format("parquet"), every).start(folder)


SINKS = ("table", "delta", "kafka")


def batch_writer(
    sink: str,
    target: str | None = None,
    key: str | None = None,
    topic: str | None = None,
    servers: str | None = None,
    folder: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """Writes one micro-batch to the chosen sink; see ``bronze_sink`` for whole streams.

    Tables and folders own a folder for each batch, Delta skips a batch it has, and a
    topic gets a repeated batch again, as it does from a stream.
    """
    if sink not in SINKS:
        raise ValueError(f"unknown sink: {sink}")
    if sink == "kafka" and not (key and (folder or (topic and servers))):
        raise ValueError("the kafka sink needs a key, and topic and servers or a folder")

    def write(batch: DataFrame, batch_id: int) -> None:
        if sink == "delta":
            writer = batch.write.format("delta").mode("append").option("mergeSchema", "true")
            writer.option("txnAppId", target).option("txnVersion", batch_id).save(target)
        elif sink == "table":
            batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")
        elif topic:
            writer = json_messages(batch, key).write.format("kafka")
            writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()
        else:
            json_messages(batch, key).write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write


def bronze_sink(df: DataFrame, sink: str = "table", **options) -> StreamingQuery:
    """Sink chosen by configuration: ``table`` (Parquet), ``delta`` or ``kafka``."""
    if sink == "kafka":
        return republish_json(df, **options)
    if sink == "delta":
        return append_table(df, table_format="delta", **options)
    if sink == "table":
        return append_table(df, **options)
    raise ValueError(f"unknown sink: {sink}")


def time_partitioned(
    df: DataFrame,
    target: str,
    checkpoint: str,
    ts: str = "kafka_ts",
    every: str | None = FILE_TRIGGER,
) -> StreamingQuery:
    """Folders topic/year/month/day/hour of the record time in UTC."""
    return append_table(
        time_partitions(df, ts),
        target,
        checkpoint,
        every,
        partition_by=("topic", "year", "month", "day", "hour"),
    )


def write_time_partitioned(
    df: DataFrame,
    target: str,
    ts: str = "kafka_ts",
    by: tuple[str, ...] = ("topic",),
    rows_per_file: int = ROWS_PER_FILE,
) -> None:
    """The same layout in batch, in files of at most about ``rows_per_file`` rows.

    The rows of each folder are counted first, from the columns that name it alone. A
    folder goes to one task, a busy one in slices to as many as it has files, so tasks are
    of like size and files few. Rows without a time go to the folder of null values.
    """
    folders = [*by, "year", "month", "day", "hour"]
    placed = time_partitions(df, ts)
    slices = F.ceil(F.count("*") / rows_per_file).cast("int").alias("_slices")
    sizes = placed.groupBy(*folders).agg(slices, F.count("*").alias("_rows"))
    rows, files, n_busy = sizes.agg(F.sum("_rows"), F.sum("_slices"), F.count_if(F.col("_slices") > 1)).first()
    # Enough tasks for the rows, and for all cores where the folders are small.
    tasks = max((rows or 0) // rows_per_file + 1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    if n_busy:
        busy = sizes.filter("_slices > 1").select(*[F.col(c).alias(f"_{c}") for c in folders], "_slices")
        same = F.lit(True)
        for c in folders:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        # A row for each rows_per_file rows at most.
        busy = F.broadcast(busy) if n_busy <= BUSY_TO_BROADCAST else busy
        everything = F.xxhash64(*[c for c, kind in df.dtypes if "map<" not in kind])
        placed = placed.join(busy, same, "left").withColumn("_slice", F.pmod(everything, F.coalesce("_slices", F.lit(1))))
        placed = placed.drop("_slices", *[f"_{c}" for c in folders])
    else:
        placed = placed.withColumn("_slice", F.lit(0))
    (
        placed.repartition(min(files or 1, tasks), *folders, "_slice")
        .drop("_slice")
        .write.partitionBy(*folders)
        .mode("append")
        .parquet(target)
    )


def console(df: DataFrame, seconds: int = 30, rows: int = 20) -> None:
    """Shows each micro-batch, untruncated, and stops after the given time."""
    query = (
        df.writeStream.format("console")
        .option("truncate", "false")
        .option("numRows", rows)
        .outputMode("append")
        .start()
    )
    try:
        query.awaitTermination(seconds)
    finally:
        query.stop()


def keyed_partitions(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """Same key, same partition, in arrival order, as a keyed topic keeps it."""
    moved = df.repartition(n, key) if n else df.repartition(key)
    return moved.sortWithinPartitions("partition", "offset")


# Commit history


def record_commit(
    spark: SparkSession, table: str, version: int, operation: str, num_rows: int
) -> None:
    """One row per version and operation; writing it again replaces the row."""
    row = (version, datetime.now(timezone.utc), operation, num_rows)
    spark.createDataFrame([row], HISTORY).coalesce(1).write.mode("overwrite").parquet(
        f"{table}/history/{version}-{operation.lower().replace(' ', '-')}"
    )


def history(spark: SparkSession, table: str) -> DataFrame:
    """Commits of a table, newest first."""
    rows = spark.read.schema(HISTORY).parquet(f"{table}/history/*")
    return rows.orderBy(F.desc("version"), F.desc("committed_at"))


def append_with_history(
    df: DataFrame, table: str, checkpoint: str, every: str | None = FILE_TRIGGER
) -> StreamingQuery:
    """Append table with one history row per micro-batch.

    A batch owns a folder and overwrites it, so a batch that runs again after a
    failure adds nothing twice. Readers take the folders the history names.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        folder = f"{table}/data/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        n = session.read.schema(batch.schema).parquet(folder).count()
        record_commit(session, table, batch_id, "STREAMING UPDATE", n)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


def read_committed(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The table as of a version, by default the newest."""
    commits = history(spark, table)
    if version is not None:
        commits = commits.filter(F.col("version") <= version)
    versions = [r["version"] for r in commits.select("version").collect()]
    return spark.read.parquet(*[f"{table}/data/batch={v}" for v in versions])


# Dead letters


def split_good_and_dead(
    decoded: DataFrame,
    write_good: Callable[[DataFrame, int], None],
    dead_target: str,
    checkpoint: str,
    shape_good,
    shape_dead,
    every: str | None = FILE_TRIGGER,
) -> StreamingQuery:
    """Good rows to one sink, dead letters to a table, from one reading of the source.

    ``write_good`` must give the same result when a batch is written again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            write_good(shape_good(batch), batch_id)
            shape_dead(batch).write.mode("overwrite").parquet(f"{dead_target}/batch={batch_id}")
        finally:
            batch.unpersist()

    writer = decoded.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return with_trigger(writer, every).start()


# Progress

PROGRESS = (
    "query STRING, run STRING, batch_id BIGINT, input_rows BIGINT, state_rows BIGINT, "
    "late_rows BIGINT"
)


class ProgressLog(StreamingQueryListener):
    """Writes the progress of the session's queries to a table, batch after batch.

    A query itself remembers its last hundred micro-batches only. Rows are written in
    files of ``rows_per_file`` and when a query ends; ``close`` writes what is left and
    ends the listening. Late rows are counted after the partial aggregation of a task, so
    the number can be lower than that of the late input rows.
    """

    def __init__(self, spark: SparkSession, table: str, rows_per_file: int = 50):
        self.spark, self.table, self.rows_per_file = spark, table, rows_per_file
        self.rows: list[tuple] = []
        self.lock = threading.Lock()
        spark.streams.addListener(self)

    def onQueryStarted(self, event) -> None:
        """Nothing to note."""

    def onQueryIdle(self, event) -> None:
        """Nothing to note."""

    def onQueryProgress(self, event) -> None:
        with self.lock:
            self.rows.append(_progress_row(event.progress))
            if len(self.rows) >= self.rows_per_file:
                self._write()

    def onQueryTerminated(self, event) -> None:
        with self.lock:
            self._write()

    def _write(self) -> None:
        if self.rows:
            frame = self.spark.createDataFrame(self.rows, PROGRESS).coalesce(1)
            frame.write.mode("append").parquet(self.table)
            self.rows = []

    def close(self) -> DataFrame:
        """Ends the listening once all events have arrived; gives the table."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)
        with self.lock:
            self._write()
        return self.spark.read.schema(PROGRESS).parquet(self.table)


def _progress_row(p) -> tuple:
    return (
        p.name,
        str(p.runId),
        p.batchId,
        p.numInputRows,
        sum(s.numRowsTotal for s in p.stateOperators),
        sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
    )


def progress_rows(query: StreamingQuery) -> list[tuple]:
    """Rows of the query's recent micro-batches, a hundred at most; see ProgressLog."""
    rows = [_progress_row(p) for p in query.recentProgress]
    return [(r[0], *r[2:]) for r in rows]


def await_any(spark: SparkSession, seconds: float | None = None) -> bool | None:
    """Waits until one of the session's queries ends."""
    if seconds is None:
        return spark.streams.awaitAnyTermination()
    return spark.streams.awaitAnyTermination(seconds)

