"""Bounded and incremental reads of a log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = "poll BIGINT, mark BIGINT"


def end_offsets(log: DataFrame) -> dict[int, int]:
    """First offset past the end of every partition, taken when this is called.

    A log has few partitions, so their ends fit into a filter of literals.
    """
    ends = log.groupBy("partition").agg((F.max("offset") + 1).alias("end"))
    return {r["partition"]: r["end"] for r in ends.collect() if r["partition"] is not None}


def read_until(log: DataFrame, ends: dict[int, int]) -> DataFrame:
    """Messages below the given end offsets; whatever came later stays unread.

    The literals reach the scan; partitions that had no messages contribute none.
    """
    inside = F.lit(False)
    for partition, end in sorted(ends.items()):
        inside = inside | ((F.col("partition") == partition) & (F.col("offset") < end))
    return log.filter(inside)


def read_after(
    table: DataFrame, id_column: str, high_water_mark: int | Column | None
) -> DataFrame:
    """Rows past a mark; the comparison reaches the scan."""
    if high_water_mark is None:
        return table
    return table.filter(F.col(id_column) > high_water_mark)


def outbox_messages(rows: DataFrame, id_column: str, key: str, topic: Column) -> DataFrame:
    """Outbox rows ``(id, event_type, payload)`` as messages to publish, keyed for order."""
    return rows.select(
        F.col(id_column).alias("outbox_id"),
        topic.alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct("event_type", "payload")).alias("value"),
    )


def stored_mark(spark: SparkSession, marks: str) -> tuple[int, int | None]:
    """Number of the last completed poll and the highest id it published; 0 and None
    before the first one."""
    try:
        polls = spark.read.schema(MARKS).parquet(f"{marks}/*")
        last = polls.orderBy(F.desc("poll")).first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        last = None
    return (last["poll"], last["mark"]) if last else (0, None)


def poll_outbox(
    outbox: DataFrame, id_column: str, marks: str, publish: Callable[[DataFrame, int], None]
) -> int | None:
    """Publishes the rows past the stored mark and stores the new one; returns it.

    ``publish`` gets the rows and the number of the poll and must replace what the same
    poll published before. The mark is stored after publishing, so a crash in between
    makes the next call repeat that poll: rows are published again, none twice. The rows
    end at the highest id seen at the start, so those that arrive meanwhile wait for
    the next poll. Ids must become visible in ascending order.
    """
    spark = outbox.sparkSession
    done, mark = stored_mark(spark, marks)
    waiting = read_after(outbox, id_column, mark)
    end = waiting.agg(F.max(id_column)).first()[0]
    if end is None:
        return mark
    publish(waiting.filter(F.col(id_column) <= end), done + 1)
    row = spark.createDataFrame([(done + 1, end)], MARKS).coalesce(1)
    row.write.mode("overwrite").parquet(f"{marks}/poll={done + 1}")
    return end
