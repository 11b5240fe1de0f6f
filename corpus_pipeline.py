"""A corpus from raw documents to a weighted mix, one operator a stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import quality
from millrace.llm.common import stored, table
from millrace.llm.decontaminate import without_leaks
from millrace.llm.linededup import without_repeated_lines
from millrace.llm.mixing import mixed
from millrace.llm.queries import ratings
from millrace.llm.simhash import keep_one_of_each_group


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose best grade is as likely as not, by a model of the rated ones."""
    model = quality.train(docs, ratings(table(spark, sf_dir, "labels")))
    return quality.select_good(docs, model)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that an earlier same or near line stands for; a document
    goes if that leaves nothing but white space."""
    return without_repeated_lines(docs, least_words=1)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, on shingles of five words."""
    return keep_one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix draws from, with the pieces that it takes."""
    return mixed(docs).filter("taken > 0")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: A fitted classifier and edit distances have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are stored and read again."""
    folder = sf_dir.rstrip("/")
    docs = table(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name)
    return docs
