"""Queries over metric samples, offsets and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import relabel
from millrace.operators import metrics as M
from millrace.plans import inputs
from millrace.plans.inputs import table
from millrace.plans.registry import plain_times, query
from millrace.schemas import MONEY

_COUNTER = """SELECT *, sum(amount) OVER (PARTITION BY topic, (n - 1) // 500 ORDER BY event_id) AS v FROM (
  SELECT event_id, ts, event_type AS topic, CAST(value AS DECIMAL(18,2)) AS amount,
         row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events)"""
_DELTAS = f"""SELECT topic, ts, CASE WHEN v < prev THEN v ELSE v - prev END AS delta FROM (
  SELECT *, lag(v) OVER (PARTITION BY topic ORDER BY event_id) AS prev FROM ({_COUNTER})) WHERE prev IS NOT NULL"""


def _grown(seconds: int, step: int) -> str:
    """Growth in (t - range, t] at every multiple t of the step, in epoch seconds."""
    first = f"CAST(ceil(epoch_us(ts) / {step}000000.0) AS BIGINT) * {step}"
    return f"""SELECT make_timestamp(t * 1000000) AS ts, topic, sum(delta) AS increase FROM (
      SELECT topic, delta, unnest(range(0, {seconds}, {step})) + {first} AS t, ts AS seen FROM ({_DELTAS}))
      WHERE t * 1000000 < epoch_us(seen) + {seconds}000000 GROUP BY 1, 2"""


def _counters(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.counter_samples(table(spark, folder, "events"))


@query(
    "counter_rate",
    f"SELECT ts, topic, CAST(increase AS DOUBLE) / 7200 AS rate FROM ({_grown(7200, 3600)})",
)
def counter_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Per-second rate over two hours, at every hour, across counter restarts."""
    return plain_times(M.counter_rate(_counters(spark, folder), 7200, ["topic"], 3600))


@query(
    "counter_increase",
    f"SELECT ts, topic, CAST(increase AS DOUBLE) AS increase FROM ({_grown(3600, 3600)})",
)
def counter_increase(spark: SparkSession, folder: str) -> DataFrame:
    grown = M.counter_increase(_counters(spark, folder), 3600, ["topic"])
    return plain_times(grown.withColumn("increase", F.col("increase").cast("double")))


_SERIES = """SELECT event_id, ts, event_type AS topic, CAST(user_id % 3 AS VARCHAR) AS "partition",
  'g' || (user_id % 5) AS consumergroup, CAST(value AS DECIMAL(18,2)) AS v FROM events"""
_INSTANT = f"""SELECT topic, "partition", consumergroup, arg_max(v, event_id) AS v FROM ({_SERIES}) GROUP BY 1, 2, 3"""


def _gauges(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.gauge_samples(table(spark, folder, "events"))


@query(
    "gauge_sums",
    f"SELECT consumergroup, CAST(sum(v) AS DOUBLE) AS value FROM ({_INSTANT}) GROUP BY 1",
)
def gauge_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Sum per group of the latest sample of each series."""
    summed = M.sum_by(M.instant(_gauges(spark, folder)), ["consumergroup"])
    return summed.withColumn("value", F.col("value").cast("double"))


@query(
    "gauge_maxima",
    f"""SELECT "partition", CAST(max(v) AS DOUBLE) AS value FROM ({_INSTANT}) GROUP BY 1""",
)
def gauge_maxima(spark: SparkSession, folder: str) -> DataFrame:
    found = M.max_by_label(M.instant(_gauges(spark, folder)), ["partition"])
    return found.withColumn("value", F.col("value").cast("double"))


@query("distinct_groups", f"SELECT count(DISTINCT consumergroup) AS n_groups FROM ({_SERIES})")
def distinct_groups(spark: SparkSession, folder: str) -> DataFrame:
    return M.distinct_groups(M.instant(_gauges(spark, folder)), "consumergroup")


@query("label_values", f"SELECT DISTINCT topic FROM ({_SERIES})")
def label_values(spark: SparkSession, folder: str) -> DataFrame:
    return M.label_values(_gauges(spark, folder), "lag", "topic")


@query(
    "produced_topics_with_lag",
    f"""SELECT topic, CAST(max(v) AS DOUBLE) AS value FROM ({_INSTANT}) WHERE topic IN
        (SELECT topic FROM ({_SERIES}) WHERE v > 400) GROUP BY 1""",
)
def produced_topics_with_lag(spark: SparkSession, folder: str) -> DataFrame:
    """Latest values of the topics that occur among samples above 400."""
    samples = _gauges(spark, folder)
    kept = M.matching_on(M.instant(samples), samples.filter(F.col("value") > 400), ["topic"])
    return M.max_by_label(kept, ["topic"]).withColumn("value", F.col("value").cast("double"))


_ENDS = """SELECT event_type AS topic, CAST(user_id % 3 AS INT) AS "partition", count(*) AS end_offset,
  count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-20') AS early FROM events GROUP BY 1, 2"""
_LAG = f"""SELECT g AS consumergroup, topic, "partition", o AS committed_offset, end_offset, end_offset - o AS lag FROM (
  SELECT *, 'billing' AS g, early AS o FROM ({_ENDS}) UNION ALL
  SELECT *, 'audit' AS g, end_offset - "partition" AS o FROM ({_ENDS}))"""


def _lag(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    return M.group_lag(inputs.end_offsets(events), inputs.committed_offsets(events))


def _lag_gauges(lag: DataFrame) -> DataFrame:
    labels = F.create_map(
        F.lit("consumergroup"), "consumergroup",
        F.lit("topic"), "topic",
        F.lit("partition"), F.col("partition").cast("string"),
    )
    return lag.select(
        F.lit("kafka_consumergroup_lag").alias("metric"), labels.alias("labels"),
        F.col("lag").alias("value"),
    )


@query("group_lag", _LAG)
def group_lag(spark: SparkSession, folder: str) -> DataFrame:
    return _lag(spark, folder)


@query(
    "groups_behind",
    f"""SELECT count(*) AS n_groups FROM (SELECT consumergroup FROM ({_LAG}) GROUP BY 1 HAVING sum(lag) > 100)""",
)
def groups_behind(spark: SparkSession, folder: str) -> DataFrame:
    return M.groups_over(_lag_gauges(_lag(spark, folder)), "consumergroup")


@query(
    "lag_severity",
    f"""SELECT consumergroup, CAST(sum(lag) AS BIGINT) AS value, CASE WHEN sum(lag) >= 10000 THEN 'critical'
        WHEN sum(lag) >= 1000 THEN 'high' WHEN sum(lag) >= 100 THEN 'elevated' ELSE 'normal' END AS severity
        FROM ({_LAG}) GROUP BY 1""",
)
def lag_severity(spark: SparkSession, folder: str) -> DataFrame:
    summed = M.sum_by(_lag_gauges(_lag(spark, folder)), ["consumergroup"])
    return summed.withColumn("severity", M.lag_severity(F.col("value")))


@query(
    "threshold_breaches",
    f"""SELECT consumergroup, topic, "partition", lag AS value, 10000.0::DOUBLE AS threshold,
        lag > 10000 AS breached FROM ({_LAG})""",
)
def threshold_breaches(spark: SparkSession, folder: str) -> DataFrame:
    checked = M.breaches(_lag_gauges(_lag(spark, folder)))
    return checked.select(
        M.label("consumergroup").alias("consumergroup"),
        M.label("topic").alias("topic"),
        M.label("partition").cast("int").alias("partition"),
        "value", "threshold", "breached",
    )


@query(
    "commit_audit",
    """SELECT 'g' || (user_id % 5) AS consumergroup, date_trunc('hour', ts) AS window_start, count(*) AS n_commits,
       max(event_id) AS max_committed_offset FROM events GROUP BY 1, 2""",
)
def commit_audit(spark: SparkSession, folder: str) -> DataFrame:
    commits = table(spark, folder, "events").select(
        F.concat(F.lit("g"), F.col("user_id") % 5).alias("consumergroup"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("committed_offset"),
    )
    return plain_times(M.commit_audit(commits, "1 hour"))


# Samples of a topic come minutes apart; two hours without one are a gap.
_RUNS = """WITH s AS (SELECT event_id, ts, event_type AS topic, value > 20 AS hot FROM events),
  p AS (SELECT *, lag(hot) OVER w AS was, lag(ts) OVER w AS was_at FROM s WINDOW w AS (PARTITION BY topic ORDER BY event_id)),
  m AS (SELECT *, CASE WHEN hot AND NOT coalesce(was AND ts - was_at <= INTERVAL 120 MINUTE, false) THEN ts END AS start FROM p),
  r AS (SELECT *, last_value(start IGNORE NULLS) OVER (PARTITION BY topic ORDER BY event_id) AS since FROM m)
  SELECT ts, topic, CASE WHEN NOT hot THEN 'inactive' WHEN ts - since >= INTERVAL 60 MINUTE THEN 'firing'
    ELSE 'pending' END AS state, CASE WHEN hot THEN since END AS active_since FROM r"""


@query("alert_states", _RUNS)
def alert_states(spark: SparkSession, folder: str) -> DataFrame:
    """Value above 20 for an hour per topic; two hours without a sample break a run."""
    samples = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("load").alias("metric"),
        F.create_map(F.lit("topic"), "event_type").alias("labels"),
        "value",
    )
    states = M.alert_states(samples, F.col("value") > 20, 3600, max_gap_seconds=7200)
    return plain_times(
        states.select("ts", M.label("topic").alias("topic"), "state", "active_since")
    )


@query(
    "alert_rule_firing",
    """WITH g AS (SELECT user_id, date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS grid,
         max({'ts': ts, 'v': CASE WHEN event_type = 'error' THEN 1 ELSE 0 END}).v AS v FROM events GROUP BY 1, 2),
       s AS (SELECT grid AS ts, sum(v) AS v FROM g GROUP BY 1),
       p AS (SELECT *, lag(v > 0) OVER (ORDER BY ts) AS was, lag(ts) OVER (ORDER BY ts) AS was_at FROM s),
       m AS (SELECT *, CASE WHEN v > 0 AND NOT coalesce(was AND ts - was_at <= INTERVAL 1 HOUR, false) THEN ts END AS start FROM p),
       r AS (SELECT *, last_value(start IGNORE NULLS) OVER (ORDER BY ts) AS since FROM m)
       SELECT ts, 'KafkaUnderReplicatedPartitions' AS alert, CAST(v AS DOUBLE) AS value,
         CASE WHEN v <= 0 THEN 'inactive' WHEN ts - since >= INTERVAL 2 MINUTE THEN 'firing' ELSE 'pending' END AS state
       FROM r""",
)
def alert_rule_firing(spark: SparkSession, folder: str) -> DataFrame:
    """A catalogued rule on a cluster sum, evaluated hourly on the latest sample of each
    user within the hour; instances report at times of their own."""
    rule = M.ALERT_RULES[0]
    samples = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit(rule.metric).alias("metric"),
        F.create_map(F.lit("instance"), F.col("user_id").cast("string")).alias("labels"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("value"),
    )
    return plain_times(
        M.evaluate_rule(
            samples, rule, step_seconds=3600, lookback_seconds=3600, max_gap_seconds=3600
        ).select("ts", "alert", "value", "state")
    )


@query(
    "instances_up",
    """SELECT count(*) FILTER (WHERE up) AS n_up FROM (
       SELECT user_id, arg_max(event_type <> 'error', event_id) AS up FROM events GROUP BY 1)""",
)
def instances_up(spark: SparkSession, folder: str) -> DataFrame:
    """Instances whose latest sample says they are up."""
    samples = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.lit("up").alias("metric"),
        F.create_map(F.lit("instance"), F.col("user_id").cast("string")).alias("labels"),
        F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value"),
    )
    return M.instances_up(samples)


# Every event is a sample of each of the four rules' metrics, by one of three brokers; the
# third stops reporting half way. Evaluated hourly, with samples seen for two hours.
_ALL_RULES = """WITH s AS (SELECT ts, 'b' || (user_id % 3) AS instance, user_id, event_type,
      date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS g FROM events
    WHERE user_id % 3 <> 2 OR event_id < (SELECT count(*) // 2 FROM events)),
  m AS (SELECT 'KafkaUnderReplicatedPartitions' AS alert, instance, ts, g, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS v FROM s
    UNION ALL SELECT 'KafkaActiveControllerCountInvalid', instance, ts, g,
      CASE WHEN instance = 'b0' AND event_type <> 'signup' OR instance = 'b1' AND event_type = 'click' THEN 1 ELSE 0 END FROM s
    UNION ALL SELECT 'KafkaOfflinePartitions', instance, ts, g, CASE WHEN event_type = 'view' THEN 2 ELSE 0 END FROM s
    UNION ALL SELECT 'KafkaBrokerDown', instance, ts, g, CASE WHEN event_type = 'error' THEN 0 ELSE 1 END FROM s),
  seen AS (SELECT alert, instance, g + to_hours(CAST(k AS INT)) AS grid, ts, v FROM m, (SELECT unnest([0, 1]) AS k)),
  last AS (SELECT alert, instance, grid, max({'ts': ts, 'v': v}).v AS v FROM seen GROUP BY ALL),
  f AS (SELECT alert, CASE WHEN alert = 'KafkaBrokerDown' THEN instance END AS instance, grid AS ts, sum(v) AS v FROM last GROUP BY ALL),
  c AS (SELECT *, CASE alert WHEN 'KafkaActiveControllerCountInvalid' THEN v <> 1 WHEN 'KafkaBrokerDown' THEN v = 0 ELSE v > 0 END AS hot FROM f),
  p AS (SELECT *, lag(hot) OVER w AS was, lag(ts) OVER w AS was_at FROM c WINDOW w AS (PARTITION BY alert, instance ORDER BY ts)),
  r AS (SELECT *, last_value(CASE WHEN hot AND NOT coalesce(was AND ts - was_at <= INTERVAL 1 HOUR, false) THEN ts END IGNORE NULLS)
      OVER (PARTITION BY alert, instance ORDER BY ts) AS since FROM p)
  SELECT ts, alert, instance, CAST(v AS DOUBLE) AS value,
    CASE WHEN NOT hot THEN 'inactive' WHEN ts > since THEN 'firing' ELSE 'pending' END AS state FROM r"""


@query("alerts_of_all_rules", _ALL_RULES)
def alerts_of_all_rules(spark: SparkSession, folder: str) -> DataFrame:
    """All four catalogued rules in one pass. A second job has an ``up`` of its own, which
    no rule may see."""
    events = table(spark, folder, "events")
    half = events.count() // 2
    broker, kind = F.col("user_id") % 3, F.col("event_type")
    instance = F.concat(F.lit("b"), broker)

    def sample(metric: str, value, job: str = "kafka-brokers"):
        labels = F.create_map(F.lit("instance"), instance, F.lit("job"), F.lit(job))
        return F.struct(F.lit(metric).alias("metric"), labels.alias("labels"), value.cast("double").alias("value"))

    replicas, controllers, up, offline = (r.metric for r in M.ALERT_RULES)
    controls = ((broker == 0) & (kind != "signup")) | ((broker == 1) & (kind == "click"))
    each = F.array(
        sample(replicas, F.when(kind == "error", 1).otherwise(0)),
        sample(controllers, F.when(controls, 1).otherwise(0)),
        sample(offline, F.when(kind == "view", 2).otherwise(0)),
        sample(up, F.when(kind == "error", 0).otherwise(1)),
        sample(up, F.lit(0), "connect"),
    )
    samples = (
        events.filter((broker != 2) | (F.col("event_id") < half))
        .select(F.col("ts").cast("timestamp").alias("ts"), F.explode(each).alias("s"))
        .select("ts", "s.*")
    )
    states = M.evaluate_rules(samples, step_seconds=3600, lookback_seconds=7200, max_gap_seconds=3600)
    return plain_times(
        states.select("ts", "alert", M.label("instance").alias("instance"), "value", "state")
    )


_LAG_SERIES = """WITH e AS (SELECT event_type AS topic, CAST(user_id % 3 AS INT) AS "partition", ts, event_id AS end_offset FROM events),
  c AS (SELECT 'g' || (user_id % 5) AS consumergroup, event_type AS topic, CAST(user_id % 3 AS INT) AS "partition",
    ts + to_minutes(CAST(event_id % 90 AS INT)) - INTERVAL 20 MINUTE AS ts, event_id - event_id % 40 AS committed_offset
    FROM events WHERE event_id % 3 = 0)
  SELECT consumergroup, c.topic, c."partition", c.ts, committed_offset, end_offset,
    CASE WHEN end_offset IS NOT NULL THEN greatest(0, end_offset - committed_offset) END AS lag
  FROM c ASOF LEFT JOIN e ON c.topic = e.topic AND c."partition" = e."partition" AND c.ts >= e.ts"""


@query("lag_series", _LAG_SERIES)
def lag_series(spark: SparkSession, folder: str) -> DataFrame:
    """Lag at every commit, by the last end offset sampled before it."""
    events = table(spark, folder, "events")
    place = [F.col("event_type").alias("topic"), (F.col("user_id") % 3).cast("int").alias("partition")]
    ts, no = F.col("ts").cast("timestamp"), F.col("event_id")
    ends = events.select(*place, ts.alias("ts"), no.alias("end_offset"))
    late = F.make_dt_interval(mins=(no % 90 - 20).cast("int"))
    committed = events.filter(no % 3 == 0).select(
        F.concat(F.lit("g"), F.col("user_id") % 5).alias("consumergroup"), *place,
        (ts + late).alias("ts"), (no - no % 40).alias("committed_offset"),
    )
    return plain_times(M.lag_over_time(ends, committed))


@query(
    "scaled_quantile",
    """SELECT event_id, CAST(value AS DECIMAL(18,2))::DOUBLE * 100 AS value FROM events WHERE event_type = 'view'""",
)
def scaled_quantile(spark: SparkSession, folder: str) -> DataFrame:
    """One ready-made quantile series, as a percentage."""
    samples = table(spark, folder, "events").select(
        "event_id",
        F.create_map(
            F.lit("quantile"),
            F.when(F.col("event_type") == "view", "99thPercentile").otherwise("Mean"),
        ).alias("labels"),
        F.col("value").cast(MONEY).cast("double").alias("value"),
    )
    return M.scaled(M.quantile_series(samples, "99thPercentile"), 100.0).drop("labels")


_RAW = """CASE event_type
  WHEN 'view' THEN 'kafka.server<type=BrokerTopicMetrics, name=MessagesInPerSec, topic=t' || user_id || '><>Count'
  WHEN 'click' THEN 'kafka.network<type=RequestMetrics, name=TotalTimeMs, request=Produce><>99thPercentile'
  WHEN 'purchase' THEN 'kafka.log<type=Log, name=LogEndOffset, topic=t' || user_id || ', partition=2><>Value'
  WHEN 'signup' THEN 'kafka.server<type=ReplicaManager, name=UnderReplicatedPartitions><>Value'
  ELSE 'some.other<type=X>Y' END"""


@query(
    "relabelled_metrics",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'kafka_server_brokertopicmetrics_messagesinpersec_total'
         WHEN 'click' THEN 'kafka_network_requestmetrics_totaltimems' WHEN 'purchase' THEN 'kafka_log_logendoffset'
         WHEN 'signup' THEN 'kafka_server_replicamanager_underreplicatedpartitions' END AS metric,
       CASE WHEN event_type IN ('view', 'purchase') THEN 't' || user_id END AS topic,
       CASE event_type WHEN 'purchase' THEN '2' END AS "partition",
       CASE event_type WHEN 'click' THEN '99thPercentile' END AS quantile,
       CASE WHEN event_type = 'view' THEN 'COUNTER' WHEN event_type <> 'error' THEN 'GAUGE' END AS metric_type,
       CAST(user_id % 3 AS VARCHAR) AS broker_id FROM events""",
)
def relabelled_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Raw bean names split into metric, labels and type by the first rule that matches."""
    raw = table(spark, folder, "events").select(
        "event_id",
        F.expr(_RAW).alias("raw_name"),
        F.concat(F.lit("kafka"), F.col("user_id") % 3, F.lit(":7071")).alias("address"),
    )
    return relabel.relabel(raw).select(
        "event_id",
        "metric",
        *[M.label(n).alias(n) for n in ("topic", "partition", "quantile")],
        "metric_type",
        relabel.extract_label(F.col("address"), relabel.BROKER_ADDRESS).alias("broker_id"),
    )


_CONNECT_RAW = """CASE event_type
  WHEN 'view' THEN 'kafka.connect<type=connect-worker-metrics, connector=c' || user_id || '><>connector-running-task-count: ' || (event_id % 9)
  WHEN 'click' THEN 'kafka.connect<type=connector-metrics, connector=c' || user_id || '><>status: paused'
  WHEN 'purchase' THEN 'kafka.connect<type=sink-task-metrics, connector=c' || user_id || ', task=3><>put-batch-avg-time-ms: 1.5E2'
  WHEN 'signup' THEN 'kafka.connect<type=connect-worker-metrics><>task-count: ' || (event_id % 5)
  ELSE 'kafka.connect<type=other><>x: 1' END"""


@query(
    "connect_metrics",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'kafka_connect_worker_connector_running_task_count'
         WHEN 'click' THEN 'kafka_connect_connector_status' WHEN 'purchase' THEN 'kafka_connect_sink_task_put_batch_avg_time_ms'
         WHEN 'signup' THEN 'kafka_connect_worker_task_count' END AS metric,
       CASE WHEN event_type IN ('view', 'click', 'purchase') THEN 'c' || user_id END AS connector,
       CASE event_type WHEN 'click' THEN 'paused' END AS status,
       CASE WHEN event_type = 'click' THEN 'UNTYPED' WHEN event_type <> 'error' THEN 'GAUGE' END AS metric_type,
       CASE event_type WHEN 'view' THEN (event_id % 9)::DOUBLE WHEN 'click' THEN 1.0 WHEN 'purchase' THEN 150.0
         WHEN 'signup' THEN (event_id % 5)::DOUBLE END AS stated_value FROM events""",
)
def connect_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Names of a connector runtime, which tell the value: metric, labels, type, value."""
    raw = table(spark, folder, "events").select("event_id", F.expr(_CONNECT_RAW).alias("raw_name"))
    return relabel.relabel(raw, rules=relabel.CONNECT_RULES).select(
        "event_id", "metric", M.label("connector").alias("connector"), M.label("status").alias("status"),
        "metric_type", "stated_value",
    )


@query(
    "status_panel",
    """SELECT connector, max(v) FILTER (WHERE event_type = 'view') AS "Running",
       max(v) FILTER (WHERE event_type = 'error') AS "Failed", max(v) FILTER (WHERE event_type = 'click') AS "Paused",
       max(v) FILTER (WHERE event_type = 'purchase') AS "Total" FROM (
       SELECT 'c' || user_id AS connector, event_type, arg_max(value, event_id) AS v FROM events
       WHERE event_type <> 'signup' GROUP BY 1, 2) GROUP BY 1""",
)
def status_panel(spark: SparkSession, folder: str) -> DataFrame:
    names = dict(zip(("view", "error", "click", "purchase"), M.STATUS_PANEL))
    metric = None
    for kind, name in names.items():
        hit = F.col("event_type") == kind
        metric = F.when(hit, name) if metric is None else metric.when(hit, name)
    samples = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        metric.alias("metric"),
        F.create_map(F.lit("connector"), F.concat(F.lit("c"), "user_id")).alias("labels"),
        "value",
    )
    return M.status_panel(samples)
