"""Batch reads of stored tables and their files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(
    spark: SparkSession, path: str, columns: list[str] | None = None, evolving: bool = False
) -> DataFrame:
    """Parquet table, optionally pruned to some columns.

    ``evolving`` merges the schemas of all files, for append-only tables whose
    producers added fields over time.
    """
    reader = spark.read
    if evolving:
        reader = reader.option("mergeSchema", "true")
    table = reader.parquet(path)
    return table.select(*columns) if columns else table


def read_partitioned(spark: SparkSession, path: str, **equals: int | str) -> DataFrame:
    """Table laid out as ``name=value`` folders; equality on those prunes folders.

    Spark reads numeric folder values as integers, so ``month=4`` finds ``month=04``.
    """
    table = spark.read.option("basePath", path).parquet(path)
    for name, value in equals.items():
        table = table.filter(F.col(name) == F.lit(value))
    return table


def read_dimension(spark: SparkSession, versioned_path: str, columns: list[str]) -> DataFrame:
    """Static side of a stream join, fixed for the life of the query.

    Give a path that is written once per version: the files are listed when the
    plan is made, so a query keeps its snapshot until it is started again.
    """
    return spark.read.parquet(versioned_path).select(*columns)


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """Files that hold rows: path, size, modification time and row count, newest first."""
    table = spark.read.parquet(path)
    return (
        table.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified_at"),
        )
        .groupBy("file_path", "file_size", "modified_at")
        .agg(F.count("*").alias("n_rows"))
        .orderBy(F.desc("modified_at"), "file_path")
    )


def peek_newest(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """First rows of the newest file, of which only that file is read."""
    newest = file_inventory(spark, path).select("file_path").limit(1).collect()
    table = spark.read.parquet(path)
    if not newest:
        return table.limit(0)
    return spark.read.schema(table.schema).parquet(newest[0]["file_path"]).limit(n)
