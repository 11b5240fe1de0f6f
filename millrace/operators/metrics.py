"""Rates, lags, alerts and status reports over metric samples.

Samples are rows ``ts, metric, labels, value``. ``labels`` is a map; grouping uses
single labels, and a whole series is identified by :func:`series_key`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.joins import floor_to
from millrace.operators.latest import latest_per_key
from millrace.operators.running import SECONDS_PER_CHUNK, Running, running, time_chunk


@dataclass(frozen=True)
class AlertRule:
    """Fires once ``value <op> threshold`` has held for ``hold_seconds``.

    ``labels`` selects series by (name, value) pairs.
    """

    name: str
    metric: str
    op: str
    threshold: float
    hold_seconds: int
    cluster_sum: bool
    labels: tuple[tuple[str, str], ...] = ()


# Alert rules, threshold catalogue, lag bands and panel columns.
ALERT_RULES = (
    AlertRule(
        "KafkaUnderReplicatedPartitions",
        "kafka_server_replicamanager_underreplicatedpartitions", ">", 0, 120, True,
    ),
    AlertRule(
        "KafkaActiveControllerCountInvalid",
        "kafka_controller_kafkacontroller_activecontrollercount", "!=", 1, 60, True,
    ),
    AlertRule("KafkaBrokerDown", "up", "==", 0, 60, False, (("job", "kafka-brokers"),)),
    AlertRule(
        "KafkaOfflinePartitions",
        "kafka_controller_kafkacontroller_offlinepartitionscount", ">", 0, 30, True,
    ),
)
THRESHOLDS = (
    ("kafka_server_replicamanager_underreplicatedpartitions", ">", 0.0),
    ("kafka_network_requestmetrics_requesthandleravgidlepercent", "<", 30.0),
    ("kafka_network_requestmetrics_networkprocessoravgidlepercent", "<", 30.0),
    ("kafka_consumergroup_lag", ">", 10000.0),
    ("jvm_gc_collection_time_ms", ">", 500.0),
)
SUM_THRESHOLDS = (("kafka_controller_kafkacontroller_activecontrollercount", "!=", 1.0),)
HEAP_METRIC = "jvm_memory_heap_used_bytes"
HEAP_SHARE = 0.8
LAG_BANDS = ((10_000, "critical"), (1_000, "high"), (100, "elevated"))
LAG_ATTENTION = 100
STATUS_PANEL = {
    "kafka_connect_worker_connector_running_task_count": "Running",
    "kafka_connect_worker_connector_failed_task_count": "Failed",
    "kafka_connect_worker_connector_paused_task_count": "Paused",
    "kafka_connect_worker_connector_total_task_count": "Total",
}
SCRAPE_SECONDS = 15
RULE_SECONDS = 30
LOOKBACK_SECONDS = 300
# End of fixed values.


def compare(value: Column, op: str, threshold: float | Column) -> Column:
    tests = {
        ">": value > threshold,
        "<": value < threshold,
        ">=": value >= threshold,
        "<=": value <= threshold,
        "==": value == threshold,
        "!=": value != threshold,
    }
    return tests[op]


def label(name: str) -> Column:
    return F.try_element_at(F.col("labels"), F.lit(name))


def series_key(metric: str = "metric", labels: str = "labels") -> Column:
    """Metric name and sorted labels as text, the identity of a series."""
    return F.to_json(
        F.struct(F.col(metric), F.array_sort(F.map_entries(labels)).alias("labels"))
    )


def _by_labels(names: list[str]) -> list[Column]:
    return [label(n).alias(n) for n in names]


# Counters


def counter_deltas(samples: DataFrame, chunk_seconds: int = SECONDS_PER_CHUNK) -> DataFrame:
    """Adds ``delta``, the growth since the previous sample of the series.

    A value below the previous one means the counter restarted from zero. The first
    sample of a series has no growth.
    """
    keyed = samples.withColumn("_series", series_key())
    lagged = running(
        keyed, ["_series"], ["ts"], time_chunk(F.col("ts"), chunk_seconds),
        Running(lags={"_previous": F.col("value")}),
    )
    grown = F.when(F.col("value") < F.col("_previous"), F.col("value")).otherwise(
        F.col("value") - F.col("_previous")
    )
    return lagged.withColumn("delta", grown).drop("_previous", "_series")


def _evaluation_times(ts: Column, range_seconds: int, step_seconds: int) -> Column:
    """Grid times ``t`` with ``ts`` in ``(t - range, t]``, in epoch microseconds."""
    micros = F.unix_micros(ts.cast("timestamp"))
    step = step_seconds * 1_000_000
    first = floor_to(micros + (step - 1), step)
    last = floor_to(micros + (range_seconds * 1_000_000 - 1), step)
    times = F.sequence(first, last, F.lit(step))
    return F.when(first <= last, times).otherwise(F.array().cast("array<bigint>"))


def counter_increase(
    samples: DataFrame,
    range_seconds: int,
    by: list[str],
    step_seconds: int | None = None,
    chunk_seconds: int = SECONDS_PER_CHUNK,
) -> DataFrame:
    """Growth within the range before each grid time, summed by labels.

    Steps default to the range. Nothing is extrapolated to the edges of a range.
    """
    step = step_seconds or range_seconds
    grown = counter_deltas(samples, chunk_seconds).filter(F.col("delta").isNotNull())
    at = _evaluation_times(F.col("ts"), range_seconds, step)
    return (
        grown.select(F.explode(at).alias("_at"), *_by_labels(by), "delta")
        .groupBy("_at", *by)
        .agg(F.sum("delta").alias("increase"))
        .select(F.timestamp_micros("_at").alias("ts"), *by, "increase")
    )


def counter_rate(
    samples: DataFrame,
    range_seconds: int,
    by: list[str],
    step_seconds: int | None = None,
    chunk_seconds: int = SECONDS_PER_CHUNK,
) -> DataFrame:
    """Growth per second, summed by labels."""
    grown = counter_increase(samples, range_seconds, by, step_seconds, chunk_seconds)
    return grown.withColumn("rate", F.col("increase").cast("double") / range_seconds).drop("increase")


# Gauges


def instant(samples: DataFrame, at: Column | None = None) -> DataFrame:
    """Latest sample of every series, up to a time if one is given."""
    seen = samples if at is None else samples.filter(F.col("ts") <= at)
    keyed = seen.withColumn("_series", series_key())
    return latest_per_key(keyed, ["_series"], ["ts"]).drop("_series")


def sum_by(gauges: DataFrame, by: list[str]) -> DataFrame:
    return gauges.groupBy(*_by_labels(by)).agg(F.sum("value").alias("value"))


def max_by_label(gauges: DataFrame, by: list[str]) -> DataFrame:
    return gauges.groupBy(*_by_labels(by)).agg(F.max("value").alias("value"))


def distinct_groups(gauges: DataFrame, name: str) -> DataFrame:
    return gauges.agg(F.countDistinct(label(name)).alias("n_groups"))


def groups_over(gauges: DataFrame, name: str, threshold: float = LAG_ATTENTION) -> DataFrame:
    """How many groups have a sum above the threshold."""
    summed = sum_by(gauges, [name])
    return summed.filter(F.col("value") > threshold).agg(F.count("*").alias("n_groups"))


def label_values(samples: DataFrame, metric: str, name: str) -> DataFrame:
    return (
        samples.filter(F.col("metric") == metric)
        .select(label(name).alias(name))
        .filter(F.col(name).isNotNull())
        .distinct()
    )


def matching_on(left: DataFrame, right: DataFrame, names: list[str]) -> DataFrame:
    """Samples of ``left`` whose labels occur in ``right``.

    The labels of ``right`` are made distinct first, so the side that is probed has
    one row per label set whatever the number of its samples.
    """
    wanted = right.select(*_by_labels(names)).distinct()
    keyed = left.select(left["*"], *[label(n).alias(f"_on_{n}") for n in names])
    same = None
    for n in names:
        test = F.col(f"_on_{n}") == F.col(n)
        same = test if same is None else same & test
    return keyed.join(wanted, same, "left_semi").drop(*[f"_on_{n}" for n in names])


def selected(samples: DataFrame, metric: str, labels: tuple[tuple[str, str], ...] = ()) -> DataFrame:
    """Samples of a metric whose labels have the given values."""
    mine = samples.filter(F.col("metric") == metric)
    for name, value in labels:
        mine = mine.filter(label(name) == value)
    return mine


def instances_up(
    samples: DataFrame, metric: str = "up", labels: tuple[tuple[str, str], ...] = ()
) -> DataFrame:
    latest = instant(selected(samples, metric, labels))
    return latest.agg(F.count_if(F.col("value") == 1).alias("n_up"))


def scaled(samples: DataFrame, factor: float) -> DataFrame:
    return samples.withColumn("value", F.col("value") * factor)


def quantile_series(samples: DataFrame, quantile: str) -> DataFrame:
    """Series of one quantile that the source has already computed."""
    return samples.filter(label("quantile") == quantile)


# Offsets and lag


def group_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages each consumer group has yet to read, per topic and partition."""
    return committed.join(ends, ["topic", "partition"]).select(
        "consumergroup",
        "topic",
        "partition",
        "committed_offset",
        "end_offset",
        (F.col("end_offset") - F.col("committed_offset")).alias("lag"),
    )


def lag_over_time(
    ends: DataFrame, committed: DataFrame, chunk_seconds: int = SECONDS_PER_CHUNK
) -> DataFrame:
    """Lag of each group at each of its commits, by the end offset known at that time.

    ``ends``: topic, partition, ts, end_offset; ``committed``: consumergroup, topic,
    partition, ts, committed_offset. Both are sampled at times of their own: a commit meets
    the last end offset at or before it, as the latest value in one ordered pass over both.
    A commit before the first end offset has no lag; a consumer cannot be ahead of what
    was last seen, so the lag is zero at least.
    """
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    both = ends.select(
        "topic", "partition", "ts", F.lit(0).alias("_kind"), no_text.alias("consumergroup"),
        no_number.alias("committed_offset"), F.col("end_offset").cast("bigint").alias("_end"),
    ).unionByName(
        committed.select(
            "topic", "partition", "ts", F.lit(1).alias("_kind"), "consumergroup",
            F.col("committed_offset").cast("bigint").alias("committed_offset"), no_number.alias("_end"),
        )
    )
    seen = running(
        both, ["topic", "partition"], ["ts", "_kind", "consumergroup", "committed_offset", "_end"],
        time_chunk(F.col("ts"), chunk_seconds), Running(lasts={"end_offset": F.col("_end")}),
    )
    lag = F.greatest(F.lit(0).cast("bigint"), F.col("end_offset") - F.col("committed_offset"))
    return seen.filter(F.col("_kind") == 1).select(
        "consumergroup", "topic", "partition", "ts", "committed_offset", "end_offset",
        F.when(F.col("end_offset").isNotNull(), lag).alias("lag"),
    )


def commit_audit(commits: DataFrame, every: str) -> DataFrame:
    """Commits and the highest offset per group and time window."""
    return (
        commits.groupBy("consumergroup", F.window("ts", every))
        .agg(
            F.count("*").alias("n_commits"),
            F.max("committed_offset").alias("max_committed_offset"),
        )
        .select(
            "consumergroup",
            F.col("window.start").alias("window_start"),
            "n_commits",
            "max_committed_offset",
        )
    )


def lag_severity(lag: Column) -> Column:
    """Band of a lag; a bound belongs to the band above it."""
    band = None
    for bound, name in LAG_BANDS:
        hit = lag >= bound
        band = F.when(hit, name) if band is None else band.when(hit, name)
    return band.otherwise("normal")


def breaches(
    gauges: DataFrame,
    thresholds=THRESHOLDS,
    sums=SUM_THRESHOLDS,
    heap_limit_bytes: float | None = None,
) -> DataFrame:
    """Latest value of every series with the threshold of its metric and whether it breaks it.

    Metrics of ``sums`` are added up over their series first and have no labels then.
    ``heap_limit_bytes`` is the maximum that the heap rule takes its share of; without
    it there is no heap rule. The catalogue is a handful of constants, so it becomes one
    expression, no join.
    """
    latest = instant(gauges) if "ts" in gauges.columns else gauges
    added = [m for m, _, _ in sums]
    totals = (
        latest.filter(F.col("metric").isin(added))
        .groupBy("metric")
        .agg(F.sum("value").alias("value"))
        .withColumn("labels", F.create_map().cast("map<string,string>"))
    )
    gauges = latest.filter(~F.col("metric").isin(added)).unionByName(
        totals, allowMissingColumns=True
    )
    thresholds = (*thresholds, *sums)
    if heap_limit_bytes is not None:
        thresholds = (*thresholds, (HEAP_METRIC, ">", HEAP_SHARE * heap_limit_bytes))
    bound = broken = None
    for metric, op, limit in thresholds:
        mine = F.col("metric") == metric
        test = compare(F.col("value"), op, limit)
        bound = F.when(mine, limit) if bound is None else bound.when(mine, limit)
        broken = F.when(mine, test) if broken is None else broken.when(mine, test)
    return gauges.withColumns({"threshold": bound, "breached": broken}).filter(
        F.col("threshold").isNotNull()
    )


def status_panel(
    samples: DataFrame, by: str = "connector", columns: dict[str, str] = STATUS_PANEL
) -> DataFrame:
    """One row per connector with the latest value of each metric as a column.

    One conditional aggregate gives what an outer join of the metrics would.
    """
    latest = instant(samples.filter(F.col("metric").isin(*columns)))
    return latest.groupBy(label(by).alias(by)).agg(
        *[
            F.max(F.when(F.col("metric") == metric, F.col("value"))).alias(name)
            for metric, name in columns.items()
        ]
    )


# Alerts


def on_grid(
    samples: DataFrame, step_seconds: int = RULE_SECONDS, lookback_seconds: int = LOOKBACK_SECONDS
) -> DataFrame:
    """What an evaluation every ``step_seconds`` sees: the last sample of each series that
    is less than ``lookback_seconds`` old, so a series that stops soon disappears.

    The samples of a step are reduced to the last one before it is spread over the
    steps that still see it.
    """
    step, back = step_seconds * 1_000_000, lookback_seconds * 1_000_000
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    last = F.max(F.struct("ts", "value"))
    steps = (
        samples.withColumns({"_series": series_key(), "_step": F.ceil(at / step) * step})
        .groupBy("_series", "_step")
        .agg(last.alias("_last"), F.first("metric").alias("metric"), F.first("labels").alias("labels"))
    )
    made = F.unix_micros(F.col("_last.ts").cast("timestamp"))
    seen = steps.withColumn(
        "_step",
        F.explode(F.sequence(F.col("_step"), F.greatest(F.col("_step"), made + back - 1), F.lit(step))),
    ).filter(F.col("_step") - made < back)
    return (
        seen.groupBy("_series", "_step")
        .agg(F.max("_last").alias("_last"), F.first("metric").alias("metric"), F.first("labels").alias("labels"))
        .select(
            F.timestamp_micros("_step").cast(samples.schema["ts"].dataType).alias("ts"),
            "metric",
            "labels",
            F.col("_last.value").alias("value"),
        )
    )


def cluster_sums(samples: DataFrame) -> DataFrame:
    """One series per metric: the sum over all instances of each time of a grid."""
    return (
        samples.groupBy("ts", "metric")
        .agg(F.sum("value").alias("value"))
        .withColumn("labels", F.create_map().cast("map<string,string>"))
    )


def alert_states(
    samples: DataFrame,
    condition: Column,
    hold_seconds: int | Column,
    max_gap_seconds: int = 2 * SCRAPE_SECONDS,
    chunk_seconds: int = SECONDS_PER_CHUNK,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Adds ``state``: inactive, pending or firing, and since when it was true.

    A run of true samples ends at a false one, and at a gap: without samples nobody
    knows that the condition still held. ``by``: columns that tell series apart besides
    metric and labels.
    """
    keys = ["_series", *by]
    keyed = samples.withColumns({"_series": series_key(), "_true": condition})
    chunk = time_chunk(F.col("ts"), chunk_seconds)
    lagged = running(
        keyed, keys, ["ts"], chunk,
        Running(lags={"_was_true": F.col("_true"), "_was_at": F.col("ts")}),
    )
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(
        F.col("_was_at").cast("timestamp")
    )
    continues = F.coalesce(
        F.col("_was_true") & (gap <= max_gap_seconds * 1_000_000), F.lit(False)
    )
    marked = lagged.withColumn(
        "_start", F.when(F.col("_true") & ~continues, F.col("ts"))
    )
    held = running(marked, keys, ["ts"], chunk, Running(lasts={"active_since": F.col("_start")}))
    age = F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(
        F.col("active_since").cast("timestamp")
    )
    state = (
        F.when(~F.coalesce(F.col("_true"), F.lit(False)), "inactive")
        .when(age >= F.lit(hold_seconds).cast("bigint") * 1_000_000, "firing")
        .otherwise("pending")
    )
    return held.withColumn("state", state).select(
        *samples.columns,
        "state",
        F.when(state != "inactive", F.col("active_since")).alias("active_since"),
    )


def evaluate_rule(
    samples: DataFrame,
    rule: AlertRule,
    step_seconds: int = RULE_SECONDS,
    lookback_seconds: int = LOOKBACK_SECONDS,
    **options,
) -> DataFrame:
    """States of a rule at every evaluation, on the latest sample of each series."""
    mine = on_grid(selected(samples, rule.metric, rule.labels), step_seconds, lookback_seconds)
    options = {"max_gap_seconds": 2 * step_seconds} | options
    if rule.cluster_sum:
        mine = cluster_sums(mine)
    test = compare(F.col("value"), rule.op, rule.threshold)
    states = alert_states(mine, test, rule.hold_seconds, **options)
    return states.withColumn("alert", F.lit(rule.name))


def _by_rule(rules: tuple[AlertRule, ...], value) -> Column:
    """A value that depends on the name of the rule in column ``alert``."""
    chosen = None
    for rule in rules:
        mine = F.col("alert") == rule.name
        chosen = F.when(mine, value(rule)) if chosen is None else chosen.when(mine, value(rule))
    return chosen


def evaluate_rules(
    samples: DataFrame,
    rules: tuple[AlertRule, ...] = ALERT_RULES,
    step_seconds: int = RULE_SECONDS,
    lookback_seconds: int = LOOKBACK_SECONDS,
    **options,
) -> DataFrame:
    """States of all rules at every evaluation, from one pass over the samples.

    The rules are a handful of constants, so they become expressions: a sample names the
    rules that select it, and threshold and duration follow from the name. Rules on a
    cluster sum add up their series at each time; the others keep every series.
    """
    named = []
    for rule in rules:
        hit = F.col("metric") == rule.metric
        for name, value in rule.labels:
            hit = hit & (label(name) == value)
        named.append(F.when(hit, F.lit(rule.name)))
    alerts = F.array_compact(F.array(*named))
    metrics = sorted({r.metric for r in rules})
    # Which series count is known from the labels, so it is settled before the grid.
    chosen = samples.filter(F.col("metric").isin(metrics)).filter(F.size(alerts) > 0)
    each = on_grid(chosen, step_seconds, lookback_seconds).withColumn("alert", F.explode(alerts))
    summed = _by_rule(rules, lambda r: F.lit(r.cluster_sum))
    none = F.create_map().cast("map<string,string>")
    series = each.withColumn("labels", F.when(summed, none).otherwise(F.col("labels")))
    added = (
        series.groupBy("ts", "alert", "metric", series_key().alias("_key"))
        .agg(F.sum("value").alias("value"), F.first("labels").alias("labels"))
        .drop("_key")
    )
    test = _by_rule(rules, lambda r: compare(F.col("value"), r.op, r.threshold))
    hold = _by_rule(rules, lambda r: F.lit(r.hold_seconds))
    options = {"max_gap_seconds": 2 * step_seconds} | options
    return alert_states(added, test, hold, by=("alert",), **options)
