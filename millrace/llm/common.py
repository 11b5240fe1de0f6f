"""Helpers the operators share: stored intermediate tables and table reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.runtime import work_folder

#: A word is a run of bytes other than the six ASCII white-space bytes.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, so that a lost executor
    costs at most the tasks that were running."""
    folder = work_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def word_count(text: Column) -> Column:
    """Number of words in a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def quoted(name: str) -> Column:
    """A column by its whole name, whatever signs that has."""
    return F.col("`" + name.replace("`", "``") + "`")


def plainly_named(df: DataFrame) -> DataFrame:
    """The same columns, those with a backtick in their name under one that Python
    functions over whole batches can take; give the names back with ``toDF``."""
    return df.toDF(*[f"_column_{i}" if "`" in c else c for i, c in enumerate(df.columns)])
