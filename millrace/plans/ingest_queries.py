"""Queries over raw lines and commands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.rules import RuleSet, is_blank
from millrace.operators.ingest import enriched_json, routed, run_statistics
from millrace.operators.saga import parse_commands
from millrace.plans.inputs import raw_lines, table
from millrace.plans.jobs import ingest_files
from millrace.plans.registry import query
from millrace.runtime import work_folder

_ROUTE = """CASE WHEN event_id % 13 = 0 THEN 'blank'
  WHEN event_id % 11 = 0 OR event_id % 7 = 0 OR event_id % 5 = 0 OR event_id % 3 = 0 THEN 'rejected'
  ELSE 'valid' END"""
_ERRORS = """CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 11 = 0 THEN 'not_an_object'
  WHEN event_id % 7 = 0 THEN 'json_decode'
  ELSE concat_ws(',', CASE WHEN event_id % 5 = 0 THEN '{null_code}:customer_id' END,
                      CASE WHEN event_id % 3 = 0 THEN 'amount_not_numeric' END) END"""


def _verdicts(lines: DataFrame, rules: RuleSet) -> DataFrame:
    return routed(lines, rules).select(
        "event_id", "route", F.concat_ws(",", "errors").alias("errors")
    )


@query(
    "ingest_routes",
    f"SELECT event_id, {_ROUTE} AS route, {_ERRORS.format(null_code='null_field')} AS errors FROM events",
)
def ingest_routes(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(raw_lines(spark, folder), RuleSet())


@query(
    "ingest_merged_codes",
    f"SELECT event_id, {_ROUTE} AS route, {_ERRORS.format(null_code='missing_or_null_field')} AS errors FROM events",
)
def ingest_merged_codes(spark: SparkSession, folder: str) -> DataFrame:
    return _verdicts(raw_lines(spark, folder), RuleSet(merge_missing_and_null=True))


@query(
    "ingest_run_statistics",
    f"""WITH r AS (SELECT {_ROUTE} AS route FROM events),
    c AS (SELECT count(*) FILTER (WHERE route <> 'blank') AS n_read,
                 count(*) FILTER (WHERE route = 'valid') AS n_valid,
                 count(*) FILTER (WHERE route = 'rejected') AS n_rejected,
                 count(*) FILTER (WHERE route = 'blank') AS n_empty_lines FROM r)
    SELECT *, CASE WHEN n_read = 0 THEN 'EMPTY' WHEN n_valid = 0 OR n_rejected > 0.1 * n_read THEN 'WARN'
              ELSE 'OK' END AS status FROM c""",
)
def ingest_run_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return run_statistics(routed(raw_lines(spark, folder)))


@query(
    "ingest_job",
    f"""WITH r AS (SELECT {_ROUTE} AS route FROM events),
    c AS (SELECT count(*) FILTER (WHERE route <> 'blank') AS n_read,
                 count(*) FILTER (WHERE route = 'valid') AS n_valid,
                 count(*) FILTER (WHERE route = 'rejected') AS n_rejected,
                 count(*) FILTER (WHERE route = 'blank') AS n_empty_lines FROM r),
    u AS (SELECT count(*) AS n_unparsed FROM events
          WHERE event_id % 13 <> 0 AND (event_id % 11 = 0 OR event_id % 7 = 0))
    SELECT *, 0 AS code, n_valid AS n_valid_written, n_rejected AS n_rejected_written,
           CASE WHEN n_valid = 0 OR n_rejected > 0.1 * n_read THEN 'WARN' ELSE 'OK' END AS status
    FROM c, u""",
)
def ingest_job(spark: SparkSession, folder: str) -> DataFrame:
    """The file job over text files: its log line, what it wrote for each route, and the
    places of the lines that are no objects, which are all different."""
    work = work_folder(spark, "ingest")
    raw_lines(spark, folder).select(F.col("line").alias("value")).write.text(f"{work}/in")
    done = ingest_files(spark, f"{work}/in", f"{work}/bronze", f"{work}/log")
    log = spark.read.json(f"{work}/log")
    value = F.col("value")
    place = F.struct(
        F.get_json_object(value, "$._source_file"), F.get_json_object(value, "$._lineno")
    )
    unparsed = F.get_json_object(value, "$._lineno").isNotNull()
    written = spark.read.text(f"{work}/bronze").filter(F.col("route").isin("valid", "rejected")).agg(
        F.count_if(F.col("route") == "valid").alias("n_valid_written"),
        F.count_if(F.col("route") == "rejected").alias("n_rejected_written"),
        F.count_distinct(F.when(unparsed, place)).alias("n_unparsed"),
    )
    names = ["n_read", "n_valid", "n_rejected", "n_empty_lines", "status"]
    return log.select(*names, F.lit(done.code).alias("code"), F.lit(1).alias("_one")).join(
        written.withColumn("_one", F.lit(1)), "_one"
    ).drop("_one")


@query(
    "ingest_documents",
    f"""SELECT event_id, {_ROUTE} AS route, 'run-1' AS batch_id, 'events' AS source_file,
      CASE WHEN event_id % 11 = 0 OR event_id % 7 = 0 THEN NULL ELSE CAST(event_id AS VARCHAR) END AS order_id,
      CASE WHEN event_id % 11 = 0 THEN '[1]' WHEN event_id % 7 = 0 THEN '{{bad' END AS raw,
      CASE WHEN event_id % 11 = 0 THEN 1 WHEN event_id % 7 = 0 THEN 1
           ELSE CAST(event_id % 5 = 0 AS INT) + CAST(event_id % 3 = 0 AS INT) END AS n_errors
      FROM events WHERE event_id % 13 <> 0""",
)
def ingest_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Stored documents, read back from their JSON."""
    judged = routed(raw_lines(spark, folder).filter(~is_blank(F.col("line"))))
    documents = enriched_json(
        judged, F.lit("run-1"), F.lit("2024-01-01T00:00:00+00:00"), F.lit("events")
    )
    stored = documents.select("event_id", "route", F.parse_json("output").alias("d"))

    def text(name: str):
        return F.try_variant_get("d", f"$.{name}", "string")

    return stored.select(
        "event_id",
        "route",
        text("_batch_id").alias("batch_id"),
        text("_source_file").alias("source_file"),
        text("order_id").alias("order_id"),
        text("_raw").alias("raw"),
        F.coalesce(
            F.size(F.try_variant_get("d", "$._errors", "array<string>")), F.lit(0)
        ).alias("n_errors"),
    )


@query(
    "ingest_three_routes",
    """SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' OR o_orderstatus = 'P' THEN 'rejected'
         WHEN o_totalprice > 100000 THEN 'suspicious' ELSE 'valid' END AS route,
       concat_ws(',', CASE WHEN o_orderpriority = '5-LOW' THEN 'amount_negative' END,
                      CASE WHEN o_orderstatus = 'P' THEN 'invalid_iso_timestamp' END) AS errors
       FROM orders""",
)
def ingest_three_routes(spark: SparkSession, folder: str) -> DataFrame:
    """Extended rules: sign, timestamp and suspicious amount."""
    amount = F.col("o_totalprice").cast("decimal(18,2)")
    signed = F.when(F.col("o_orderpriority") == "5-LOW", -amount).otherwise(amount)
    created = F.when(F.col("o_orderstatus") == "P", F.lit("soon")).otherwise(
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    line = F.to_json(
        F.struct(
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            signed.alias("amount"),
            F.lit("EUR").alias("currency"),
            created.alias("created_at"),
        )
    )
    lines = table(spark, folder, "orders").select("o_orderkey", line.alias("line"))
    return routed(lines, RuleSet(extended=True)).select(
        "o_orderkey", "route", F.concat_ws(",", "errors").alias("errors")
    )


def place_order_messages(orders: DataFrame) -> DataFrame:
    """PlaceOrder commands of all orders; each priority stands for one kind of command."""
    text = F.to_json(
        F.struct(
            F.when(F.col("o_orderpriority") == "1-URGENT", "CancelOrder")
            .otherwise("PlaceOrder")
            .alias("command_type"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.when(
                F.col("o_orderpriority") != "2-HIGH",
                F.array(
                    F.struct(
                        F.lit("SKU-001").alias("sku"),
                        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", 2).alias("quantity"),
                        F.col("o_totalprice").alias("unit_price"),
                    )
                ),
            ).alias("items"),
            F.lit("EUR").alias("currency"),
        )
    )

    cut = F.when(F.col("o_orderpriority") == "3-MEDIUM", F.substring(text, 1, 20)).otherwise(text)
    return orders.select("o_orderkey", "o_orderdate", cut.alias("value"))


@query(
    "command_validation",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'unknown_command'
         WHEN '2-HIGH' THEN 'missing:items' WHEN '3-MEDIUM' THEN 'unreadable'
         WHEN '4-NOT SPECIFIED' THEN 'invalid:items' ELSE 'accepted' END AS verdict FROM orders""",
)
def command_validation(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parse_commands(place_order_messages(table(spark, folder, "orders")))
    return parsed.select(
        "o_orderkey", F.coalesce("error_message", F.lit("accepted")).alias("verdict")
    )


@query(
    "command_strictness",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN 'invalid:customer_id' WHEN 1 THEN 'unreadable'
         WHEN 2 THEN 'invalid:items' WHEN 3 THEN 'unreadable' ELSE 'accepted' END AS verdict
       FROM orders WHERE o_orderpriority = '5-LOW'""",
)
def command_strictness(spark: SparkSession, folder: str) -> DataFrame:
    """Commands that a lenient parser would take: a customer id that is a number, text after
    the command, a quantity in words, and two commands in one message."""
    order, text = F.col("o_orderkey"), F.col("value")
    whole = place_order_messages(table(spark, folder, "orders").filter("o_orderpriority = '5-LOW'"))
    broken = (
        F.when(order % 5 == 0, F.regexp_replace(text, r'"customer_id":"(\d+)"', r'"customer_id":$1'))
        .when(order % 5 == 1, F.concat(text, F.lit(" and more")))
        .when(order % 5 == 2, F.replace(text, F.lit('"quantity":2'), F.lit('"quantity":"two"')))
        .when(order % 5 == 3, F.concat(text, text))
        .otherwise(text)
    )
    parsed = parse_commands(whole.withColumn("value", broken))
    return parsed.select("o_orderkey", F.coalesce("error_message", F.lit("accepted")).alias("verdict"))
