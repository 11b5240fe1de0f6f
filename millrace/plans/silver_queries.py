"""Queries over event-time windows and stream joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import counts
from millrace.plans import inputs
from millrace.plans.inputs import table, table_stream
from millrace.plans.jobs import silver_job
from millrace.plans.registry import drained, plain_times, query
from millrace.runtime import stored, work_folder
from millrace.sources.tables import read_dimension
from millrace.streaming import joins, sinks, windows
from millrace.streaming.upsert import read_state, upsert_stream

HOUR = 3600
_FINAL = "(SELECT max(ts) - INTERVAL {delay} FROM events)"


def _with_double(df: DataFrame, *money: str) -> DataFrame:
    return plain_times(df.withColumns({m: F.col(m).cast("double") for m in money}))


def _tumbling(unit: str, length: str, final: bool) -> str:
    limit = f"WHERE window_end <= {_FINAL.format(delay='10 MINUTE')}" if final else ""
    return f"""WITH w AS (SELECT date_trunc('{unit}', ts) AS window_start,
        date_trunc('{unit}', ts) + INTERVAL {length} AS window_end, event_type AS status,
        count(*) AS orders_count, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
      FROM events GROUP BY 1, 2, 3)
    SELECT * FROM w {limit}"""


@query("revenue_by_hour", _tumbling("hour", "1 HOUR", final=True))
def revenue_by_hour(spark: SparkSession, folder: str) -> DataFrame:
    """Stream: windows that the watermark has closed."""
    orders = inputs.orders_stream(table_stream(spark, folder, "events"))
    closed = windows.revenue_by_window(orders, length="1 hour")
    return _with_double(drained(closed, "revenue-hour"), "revenue")


@query("revenue_by_minute", _tumbling("minute", "1 MINUTE", final=False))
def revenue_by_minute(spark: SparkSession, folder: str) -> DataFrame:
    """The same over the stored table, where every window is complete."""
    orders = inputs.orders_stream(table(spark, folder, "events"))
    return _with_double(windows.revenue_by_window(orders), "revenue")


def _sliding(final: bool) -> str:
    limit = f"WHERE window_end <= {_FINAL.format(delay='10 MINUTE')}" if final else ""
    return f"""WITH e AS (SELECT date_trunc('minute', ts) - to_minutes(k) AS window_start,
        event_type AS status, CAST(value AS DECIMAL(18,2)) AS amount
      FROM events, (SELECT CAST(unnest(range(5)) AS INT) AS k)),
    w AS (SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, status,
        CAST(sum(amount) AS DOUBLE) / count(*) AS avg_basket, count(*) AS orders_count
      FROM e GROUP BY 1, 2, 3)
    SELECT * FROM w {limit}"""


@query("basket_by_sliding_window", _sliding(final=True))
def basket_by_sliding_window(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.orders_stream(table_stream(spark, folder, "events"))
    return plain_times(drained(windows.basket_by_window(orders), "basket"))


@query("basket_by_sliding_window_stored", _sliding(final=False))
def basket_by_sliding_window_stored(spark: SparkSession, folder: str) -> DataFrame:
    orders = inputs.orders_stream(table(spark, folder, "events"))
    return plain_times(windows.basket_by_window(orders))


def _session_sql(final: bool) -> str:
    limit = f"WHERE window_end <= {_FINAL.format(delay='10 MINUTE')}" if final else ""
    return f"""WITH p AS (SELECT user_id, ts, value, CASE WHEN ts - lag(ts) OVER u <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh
        FROM events WINDOW u AS (PARTITION BY user_id ORDER BY event_id)),
    s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM p),
    w AS (SELECT min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, user_id AS customer_id,
        count(*) AS n_events, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM s GROUP BY user_id, n)
    SELECT * FROM w {limit}"""


@query("customer_sessions", _session_sql(final=True))
def customer_sessions(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.orders_stream(table_stream(spark, folder, "events"))
    closed = windows.sessions(events, amount="total_amount")
    return _with_double(drained(closed, "sessions"), "amount")


@query("customer_sessions_stored", _session_sql(final=False))
def customer_sessions_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The same over the stored table, without one task per customer."""
    events = inputs.orders_stream(table(spark, folder, "events"))
    return _with_double(windows.sessions(events, amount="total_amount"), "amount")


_DEMO = f"""WITH w AS (SELECT time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '2000-01-01') AS window_start, count(*) AS n_events
    FROM events GROUP BY 1)
  SELECT window_start, window_start + INTERVAL 30 SECOND AS window_end, n_events FROM w
  WHERE window_start + INTERVAL 30 SECOND <= {_FINAL.format(delay='1 MINUTE')}"""


@query("late_data_windows", _DEMO)
def late_data_windows(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.orders_stream(table_stream(spark, folder, "events"))
    return plain_times(drained(windows.counts_by_window(events), "late"))


@query(
    "stream_progress",
    "SELECT 'progress' AS query, CAST(count(*) AS BIGINT) AS input_rows, CAST(0 AS BIGINT) AS late_rows FROM events",
)
def stream_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Progress metrics of a windowed stream."""
    work = work_folder(spark, "progress")
    events = inputs.orders_stream(table_stream(spark, folder, "events"))
    log = sinks.ProgressLog(spark, f"{work}/progress")
    running = sinks.append_table(
        windows.counts_by_window(events), f"{work}/table", f"{work}/checkpoint",
        every=None, name="progress",
    )
    running.awaitTermination()
    mine = log.close().filter(F.col("run") == str(running.runId))
    return mine.groupBy("query").agg(
        F.sum("input_rows").alias("input_rows"), F.sum("late_rows").alias("late_rows")
    )


# Of every fourth 30-second window of the first half its first event comes too late.
_LATE = f"""WITH e AS (SELECT *, time_bucket(INTERVAL 30 SECOND, ts, TIMESTAMP '2000-01-01') AS w FROM events),
  held AS (SELECT w, min(event_id) AS event_id FROM e WHERE event_id <= (SELECT count(*) // 2 FROM events)
    GROUP BY w HAVING min(event_id) % 4 = 0),
  seen AS (SELECT * FROM e WHERE event_id NOT IN (SELECT event_id FROM held))
  SELECT w AS window_start, count(*) AS n_events, CAST(NULL AS BIGINT) AS late_rows FROM seen
    WHERE w + INTERVAL 30 SECOND <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM seen) GROUP BY w
  UNION ALL SELECT NULL, NULL, count(*) FROM held"""


@query("late_rows_dropped", _LATE)
def late_rows_dropped(spark: SparkSession, folder: str) -> DataFrame:
    """Windows without the rows that came after the watermark, and how many those were,
    as the progress of the query tells. Rows of one window and task count once there; here
    each late row has a window of its own."""
    work = work_folder(spark, "late")
    events = table(spark, folder, "events")
    half = F.lit(events.count() // 2)
    bucket = F.window("ts", "30 seconds").getField("start")
    held = (
        events.filter(F.col("event_id") <= half).groupBy(bucket.alias("_w"))
        .agg(F.min("event_id").alias("_held")).filter(F.col("_held") % 4 == 0).select("_held")
    )
    marked = events.join(held, F.col("event_id") == F.col("_held"), "left")
    batch = F.when(F.col("_held").isNotNull(), 2).when(F.col("event_id") <= half, 0).otherwise(1)
    placed = stored(marked.withColumn("_arrives", batch).drop("_held"), "late-events")
    log = sinks.ProgressLog(spark, f"{work}/progress")
    runs = []
    for stream in inputs.arriving(placed, F.col("_arrives"), 3, f"{work}/events"):
        counted = windows.counts_by_window(inputs.orders_stream(stream))
        runs.append(sinks.append_table(counted, f"{work}/table", f"{work}/checkpoint", every=None, name="late"))
        runs[-1].awaitTermination()
    mine = log.close().filter(F.col("run").isin([str(r.runId) for r in runs]))
    late = mine.agg(F.sum("late_rows").alias("late_rows")).select(
        F.lit(None).cast("timestamp_ntz").alias("window_start"), F.lit(None).cast("bigint").alias("n_events"), "late_rows"
    )
    closed = plain_times(spark.read.parquet(f"{work}/table")).select(
        "window_start", "n_events", F.lit(None).cast("bigint").alias("late_rows")
    )
    return closed.union(late)


@query("updated_windows", _tumbling("hour", "1 HOUR", final=False))
def updated_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Update mode: open windows are emitted too, and upserted by window and status."""
    work = work_folder(spark, "updated")
    orders = inputs.orders_stream(table_stream(spark, folder, "events"))
    keys = ["window_start", "status"]
    upsert_stream(
        windows.revenue_by_window(orders, length="1 hour"), f"{work}/table", f"{work}/checkpoint",
        keys, newest_by=("orders_count",), every=None, output_mode="update",
    ).awaitTermination()
    return _with_double(
        read_state(spark, f"{work}/table", keys, newest_by=("orders_count",)), "revenue"
    )


@query(
    "orders_enriched",
    """SELECT o_orderkey AS order_id, o_custkey AS customer_id, c_name AS email, n_name AS country,
       o_orderstatus AS status, o_totalprice AS total_amount, o_orderdate AS kafka_ts
       FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def orders_enriched(spark: SparkSession, folder: str) -> DataFrame:
    """Stream of orders with a version of the customer dimension that is written once."""
    version = f"{work_folder(spark, 'dimension')}/version=1"
    inputs.customers_dimension(
        table(spark, folder, "customer"), table(spark, folder, "nation")
    ).write.parquet(version)
    customers = read_dimension(spark, version, ["customer_id", "email", "country"])
    orders = table_stream(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").cast("timestamp").alias("kafka_ts"),
    )
    joined = joins.orders_enriched(orders, customers)
    return plain_times(drained(joined, "enriched"))


_PAIRS = """SELECT o.user_id AS order_id, o.event_id AS customer_id, o.value AS order_amount, o.ts AS order_ts,
  p.value AS payment_amount, p.ts AS payment_ts,
  CAST(epoch(date_trunc('second', p.ts)) AS BIGINT) - CAST(epoch(date_trunc('second', o.ts)) AS BIGINT) AS delay_seconds
  FROM (SELECT * FROM events WHERE event_type = 'view') o {how} JOIN
       (SELECT * FROM events WHERE event_type = 'purchase') p
  ON o.user_id = p.user_id AND p.ts >= o.ts AND p.ts <= o.ts + INTERVAL 60 MINUTE"""


def _paid(events_of, how: str) -> DataFrame:
    return joins.orders_with_payments(
        inputs.of_type(events_of(), "view", "total_amount"),
        inputs.of_type(events_of(), "purchase", "amount"),
        within_seconds=HOUR,
        how=how,
    )


@query("orders_paid", _PAIRS.format(how="INNER"))
def orders_paid(spark: SparkSession, folder: str) -> DataFrame:
    joined = _paid(lambda: table_stream(spark, folder, "events"), "inner")
    return _with_double(drained(joined, "paid"), "order_amount", "payment_amount")


@query(
    "orders_paid_or_expired",
    f"""{_PAIRS.format(how='LEFT')} WHERE p.ts IS NOT NULL OR o.ts + INTERVAL 60 MINUTE <= (
      SELECT least(max(ts) FILTER (WHERE event_type = 'view'), max(ts) FILTER (WHERE event_type = 'purchase'))
             - INTERVAL 10 MINUTE FROM events)""",
)
def orders_paid_or_expired(spark: SparkSession, folder: str) -> DataFrame:
    """Left outer: orders whose hour has passed without a payment come with nulls."""
    joined = _paid(lambda: table_stream(spark, folder, "events"), "left_outer")
    return _with_double(drained(joined, "expired"), "order_amount", "payment_amount")


@query("orders_paid_stored", _PAIRS.format(how="LEFT"))
def orders_paid_stored(spark: SparkSession, folder: str) -> DataFrame:
    """The interval join over stored tables."""
    joined = _paid(lambda: table(spark, folder, "events"), "left_outer")
    return _with_double(joined, "order_amount", "payment_amount")


@query(
    "payment_latency",
    f"""SELECT count(*) AS paid_orders, CAST(sum(delay_seconds) AS DOUBLE) / count(*) AS avg_delay_seconds
        FROM ({_PAIRS.format(how='INNER')})""",
)
def payment_latency(spark: SparkSession, folder: str) -> DataFrame:
    return counts.payment_latency(_paid(lambda: table(spark, folder, "events"), "inner"))


_SILVER = f"""SELECT 'revenue' AS name, count(*) AS n FROM ({_tumbling('minute', '1 MINUTE', final=True)})
  UNION ALL SELECT 'basket', count(*) FROM ({_sliding(final=True)})
  UNION ALL SELECT 'late', count(*) FROM ({_DEMO})
  UNION ALL SELECT 'enriched', count(*) FROM events
  UNION ALL SELECT 'paid', count(*) FROM ({_PAIRS.format(how="INNER").replace("60 MINUTE", "15 MINUTE")})"""


@query("silver_tables", _SILVER)
def silver_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of the five silver tables that one job writes side by side."""
    root = work_folder(spark, "silver")
    version = f"{root}/customers/version=1"
    inputs.customers_dimension(
        table(spark, folder, "customer"), table(spark, folder, "nation")
    ).write.parquet(version)
    started = silver_job(
        inputs.orders_stream(table_stream(spark, folder, "events")),
        inputs.of_type(table_stream(spark, folder, "events"), "view", "total_amount"),
        inputs.of_type(table_stream(spark, folder, "events"), "purchase", "amount"),
        read_dimension(spark, version, ["customer_id", "email", "country"]),
        root,
        every=None,
    )
    for running in started:
        running.awaitTermination()
    counted = None
    for name in ("revenue", "basket", "late", "enriched", "paid"):
        rows = spark.read.parquet(f"{root}/{name}").agg(F.count("*").alias("n"))
        rows = rows.select(F.lit(name).alias("name"), "n")
        counted = rows if counted is None else counted.union(rows)
    return counted
