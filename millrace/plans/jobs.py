"""Whole jobs: source, operators and sinks put together."""

from __future__ import annotations

import sys
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.cdc import flatten_decoded, with_lineage
from millrace.functions.rules import RuleSet, is_blank
from millrace.operators.ingest import enriched_json, routed, run_statistics, with_status
from millrace.schemas import CDC_ORDER, RUN_LOG
from millrace.sources import envelope as E
from millrace.sources.lines import read_lines, split_counts, stream_lines, with_line_numbers
from millrace.streaming import joins, sinks, windows

# Exit codes of an ingest run.
EXIT_DONE = 0
EXIT_NO_SOURCE = 1
EXIT_EMPTY = 2


@dataclass(frozen=True)
class IngestResult:
    code: int
    log: dict | None


def ingest_files(
    spark: SparkSession,
    source: str,
    bronze: str,
    log: str,
    rules: RuleSet = RuleSet(),
    batch_id: str | None = None,
    now: datetime | None = None,
) -> IngestResult:
    """JSON lines to ``bronze/route=…/_batch_id=…`` plus one line in the run log.

    The source is read twice: a count of lines per file split, needed for line
    numbers, and the pass that parses, routes and writes. What was rejected is then
    counted from what was written, so a task that runs again is not counted twice.
    """
    try:
        lines = read_lines(spark, source)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        print(f"ERROR: source not found: {source}", file=sys.stderr)
        return IngestResult(EXIT_NO_SOURCE, None)

    batch_id = batch_id or str(uuid.uuid4())
    started = now or datetime.now(timezone.utc)
    places = f"{bronze}/_splits/_batch_id={batch_id}"
    counted = split_counts(lines)
    counted.write.mode("overwrite").parquet(places)
    splits = spark.read.schema(counted.schema).parquet(places)

    # Blank lines go before routing: a filter on the route would be pushed below it and
    # repeat the parsing.
    written_lines = with_line_numbers(lines, splits).filter(~is_blank(F.col("line")))
    judged = routed(written_lines, rules)
    documents = enriched_json(
        judged, F.lit(batch_id), F.lit(started.isoformat()), F.col("source_file")
    )
    documents.select(
        F.col("output").alias("value"), "route", F.lit(batch_id).alias("_batch_id")
    ).write.mode("append").partitionBy("route", "_batch_id").text(bronze)

    rejected = _count_text(spark, f"{bronze}/route=rejected/_batch_id={batch_id}")
    totals = splits.agg(
        F.coalesce(F.sum(F.col("n_lines") - F.col("n_blank")), F.lit(0)).alias("n_read"),
        F.coalesce(F.sum("n_blank"), F.lit(0)).alias("n_empty_lines"),
    )
    counts = with_status(
        totals.withColumns(
            {"n_rejected": F.lit(rejected), "n_valid": F.col("n_read") - rejected}
        )
    )
    entry = counts.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(source).alias("source"),
        F.lit(started.isoformat()).alias("started"),
        F.lit((now or datetime.now(timezone.utc)).isoformat()).alias("finished"),
        "n_read", "n_valid", "n_rejected", "n_empty_lines", "status",
    ).to(RUN_LOG)
    row = entry.first().asDict()
    spark.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("append").json(log)
    return IngestResult(EXIT_DONE if row["n_read"] else EXIT_EMPTY, row)


def _count_text(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.text(path).count()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0


def ingest_stream(
    spark: SparkSession,
    source: str,
    bronze: str,
    log: str,
    checkpoint: str,
    rules: RuleSet = RuleSet(),
    every: str | None = sinks.FILE_TRIGGER,
) -> StreamingQuery:
    """The same for files that keep arriving; each micro-batch is a run."""

    def write(batch: DataFrame, batch_number: int) -> None:
        session = batch.sparkSession
        batch_id = f"batch-{batch_number}"
        stamp = datetime.now(timezone.utc).isoformat()
        judged = routed(batch, rules)
        documents = enriched_json(judged, F.lit(batch_id), F.lit(stamp), F.col("source_file"))
        folder = f"{bronze}/_batch_id={batch_id}"
        documents.select(F.col("output").alias("value"), "route").write.mode(
            "overwrite"
        ).partitionBy("route").text(folder)
        written = session.read.schema("value STRING, route STRING").text(folder)
        row = run_statistics(written).first().asDict()
        row |= {"batch_id": batch_id, "source": source, "started": stamp,
                "finished": datetime.now(timezone.utc).isoformat()}
        session.createDataFrame([row], RUN_LOG).coalesce(1).write.mode("overwrite").json(
            f"{log}/{batch_id}"
        )

    writer = stream_lines(spark, source).writeStream.foreachBatch(write)
    return sinks.with_trigger(writer.option("checkpointLocation", checkpoint), every).start()


def bronze_orders(
    decoded: DataFrame, ingested_at: datetime | None = None, layer: str = "orders",
    strict: bool = False,
) -> DataFrame:
    """Decoded messages as flat bronze rows with lineage."""
    return with_lineage(
        flatten_decoded(E.good_messages(decoded, strict)), layer, ingested_at
    )


def bronze_job(
    messages: DataFrame,
    target: str,
    checkpoint: str,
    dead_target: str | None = None,
    schema: T.StructType = CDC_ORDER,
    required: tuple[str, ...] = ("order_id",),
    every: str | None = sinks.FILE_TRIGGER,
    ingested_at: datetime | None = None,
    sink: str = "table",
    **sink_options,
) -> StreamingQuery:
    """Framed CDC messages to the bronze table; broken ones to ``dead_target``.

    Without ``dead_target`` the job is strict: the first broken message stops it. ``sink``
    is ``table``, ``delta`` or ``kafka``, with or without dead letters.
    """
    if sink not in sinks.SINKS:
        raise ValueError(f"unknown sink: {sink}")
    decoded = E.decode(messages, E.json_payload(schema), list(required))
    if dead_target is None:
        rows = bronze_orders(decoded, ingested_at, strict=True)
        if sink == "kafka":
            return sinks.republish_json(rows, "kafka_key", checkpoint, every, **sink_options)
        return sinks.bronze_sink(
            rows, sink, target=target, checkpoint=checkpoint, every=every, **sink_options
        )
    if sink == "kafka":
        sink_options = {"key": "kafka_key", **sink_options}
    return sinks.split_good_and_dead(
        decoded,
        sinks.batch_writer(sink, target, **sink_options),
        dead_target,
        checkpoint,
        lambda batch: bronze_orders(batch, ingested_at),
        E.dead_letters,
        every,
    )


def silver_job(
    orders: DataFrame,
    paid_orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    root: str,
    every: str | None = sinks.FILE_TRIGGER,
) -> list[StreamingQuery]:
    """Starts the five silver queries on one session, each with a table and a checkpoint
    of its own below ``root``: tumbling revenue, sliding basket, the late-data demo,
    orders with their customer, and orders with their payment.

    With a trigger interval, wait for ``sinks.await_any``: the end of one query is a
    failure then. With none, each of them ends once it has read what there is.
    """
    tables = {
        "revenue": windows.revenue_by_window(orders),
        "basket": windows.basket_by_window(orders),
        "late": windows.counts_by_window(orders),
        "enriched": joins.orders_enriched(orders, customers),
        "paid": joins.orders_with_payments(paid_orders, payments),
    }
    return [sinks.silver_table(rows, root, name, every) for name, rows in tables.items()]
