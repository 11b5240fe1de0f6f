"""Validation and routing of JSON lines, and the statistics of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import rules as R
from millrace.functions.rules import RuleSet


def routed(lines: DataFrame, rules: RuleSet = RuleSet(), line: str = "line") -> DataFrame:
    """Adds ``record`` (variant), ``errors`` and ``route`` to each line."""
    parsed = lines.withColumn("record", R.strict_variant(F.col(line)))
    judged = parsed.withColumn(
        "errors",
        F.when(~R.is_blank(F.col(line)), R.line_errors(F.col(line), F.col("record"), rules)),
    )
    return judged.withColumn(
        "route", R.route(F.col(line), F.col("record"), F.col("errors"), rules)
    )


def enriched_json(
    routed_lines: DataFrame,
    batch_id: Column,
    ingested_at: Column,
    source_file: Column,
    line: str = "line",
) -> DataFrame:
    """Adds ``output``: the JSON document to store for each routed line.

    All input fields are kept and the ingestion fields override fields of the same
    name. Lines that are not objects carry their number and text instead.
    """
    stamps = {
        "_ingestion_timestamp": ingested_at, "_batch_id": batch_id, "_source_file": source_file,
    }
    metadata = [
        part
        for name, value in stamps.items()
        for part in (F.lit(name), value.cast("string").cast("variant"))
    ]
    errors = [F.lit("_errors"), F.to_variant_object("errors")]
    fields = F.try_variant_get("record", "$", "map<string,variant>")

    def document_of(added: list[Column], names: list[str]) -> Column:
        kept = F.map_filter(fields, lambda name, _: ~name.isin(names))
        return F.to_json(F.map_concat(kept, F.create_map(*added)))

    valid = document_of(metadata, list(stamps))
    rejected = document_of([*metadata, *errors], [*stamps, "_errors"])
    has_number = "lineno" in routed_lines.columns
    number = F.col("lineno") if has_number else F.lit(None).cast("bigint")
    unparsed = F.create_map(
        F.lit("_lineno"), number.cast("variant"),
        F.lit("_raw"), F.col(line).cast("variant"),
        *errors, *metadata,
    )
    parsed = F.col("record").isNotNull() & R.is_object(F.col(line))
    document = (
        F.when(~parsed, F.to_json(unparsed))
        .when(F.col("route") == "rejected", rejected)
        .otherwise(valid)
    )
    return routed_lines.withColumn("output", document)


def run_statistics(routed_lines: DataFrame) -> DataFrame:
    """One row: lines read, valid, rejected and blank, and the status of the run.

    Suspicious lines are not errors, so they count as valid.
    """
    n_read = F.count_if(F.col("route") != "blank").alias("n_read")
    return with_status(
        routed_lines.agg(
            n_read,
            F.count_if(F.col("route").isin("valid", "suspicious")).alias("n_valid"),
            F.count_if(F.col("route") == "rejected").alias("n_rejected"),
            F.count_if(F.col("route") == "blank").alias("n_empty_lines"),
        )
    )


def with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn(
        "status", R.run_status(F.col("n_read"), F.col("n_valid"), F.col("n_rejected"))
    )
