"""JSON-lines files as rows, with per-file line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions.rules import is_blank


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line, source_file`` and the position of each line.

    Invalid bytes become the replacement character and are flagged in ``replaced``.
    ``_split`` and ``_row`` say where the line lies in its part of the file.
    """
    return _decoded(spark.read.text(path)).withColumns(
        {
            "_split": F.col("_metadata.file_block_start"),
            "_row": F.monotonically_increasing_id(),
        }
    )


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same for files that keep arriving in a folder; lines have no number there."""
    return _decoded(spark.readStream.text(path))


def _decoded(df: DataFrame) -> DataFrame:
    return df.select(
        F.make_valid_utf8("value").alias("line"),
        (~F.is_valid_utf8("value")).alias("replaced"),
        F.col("_metadata.file_path").alias("source_file"),
    )


def split_counts(lines: DataFrame) -> DataFrame:
    """One row per file split: its line counts and the lines of the file before it.

    Lines start in the split they belong to, so splits ordered by their start give
    the order of the file. The window sees one row per split, never the lines.
    """
    counts = lines.groupBy("source_file", "_split").agg(
        F.min("_row").alias("_first_row"),
        F.count("*").alias("n_lines"),
        F.count_if(is_blank(F.col("line"))).alias("n_blank"),
        F.count_if("replaced").alias("n_replaced"),
    )
    before = Window.partitionBy("source_file").orderBy("_split").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return counts.withColumn(
        "_lines_before", F.coalesce(F.sum("n_lines").over(before), F.lit(0))
    )


def with_line_numbers(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """Adds the 1-based ``lineno``, which counts blank lines too."""
    places = splits.select("source_file", "_split", "_first_row", "_lines_before")
    numbered = lines.join(places, ["source_file", "_split"])
    number = F.col("_row") - F.col("_first_row") + F.col("_lines_before") + 1
    return numbered.withColumn("lineno", number).drop("_first_row", "_lines_before")
