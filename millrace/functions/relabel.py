"""Raw management-bean names to metric name, labels and type."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``$n`` in name, labels and value stands for the n-th group of the pattern.

    ``value`` is what the sample is worth where its name tells it.
    """

    pattern: str
    name: str
    kind: str
    labels: dict[str, str] = field(default_factory=dict)
    value: str | None = None


# Exporter rules of a message broker, tried in this order.
BROKER_RULES = (
    Rule(
        r"kafka.server<type=(.+), name=(.+), topic=(.+)><>Count",
        "kafka_server_$1_$2_total",
        "COUNTER",
        {"topic": "$3"},
    ),
    Rule(
        r"kafka.server<type=(.+), name=(.+), topic=(.+)><>"
        r"(OneMinuteRate|FiveMinuteRate|FifteenMinuteRate|MeanRate)",
        "kafka_server_$1_$2",
        "GAUGE",
        {"topic": "$3", "window": "$4"},
    ),
    Rule(r"kafka.server<type=(.+), name=(.+)><>Count", "kafka_server_$1_$2_total", "COUNTER"),
    Rule(
        r"kafka.server<type=(.+), name=(.+)><>"
        r"(Value|OneMinuteRate|FiveMinuteRate|FifteenMinuteRate|MeanRate|Mean)",
        "kafka_server_$1_$2",
        "GAUGE",
    ),
    Rule(
        r"kafka.server<type=ReplicaManager, name=(.+)><>Value",
        "kafka_server_replicamanager_$1",
        "GAUGE",
    ),
    Rule(
        r"kafka.server<type=ReplicaManager, name=(.+)><>Count",
        "kafka_server_replicamanager_$1_total",
        "COUNTER",
    ),
    Rule(r"kafka.controller<type=(.+), name=(.+)><>Value", "kafka_controller_$1_$2", "GAUGE"),
    Rule(
        r"kafka.controller<type=(.+), name=(.+)><>Count",
        "kafka_controller_$1_$2_total",
        "COUNTER",
    ),
    Rule(
        r"kafka.network<type=RequestMetrics, name=(.+), request=(.+)><>"
        r"(Count|OneMinuteRate|Mean|99thPercentile)",
        "kafka_network_requestmetrics_$1",
        "GAUGE",
        {"request": "$2", "quantile": "$3"},
    ),
    Rule(
        r"kafka.log<type=Log, name=(Size|NumLogSegments|LogStartOffset|LogEndOffset), "
        r"topic=(.+), partition=(.+)><>Value",
        "kafka_log_$1",
        "GAUGE",
        {"topic": "$2", "partition": "$3"},
    ),
    Rule(r"java.lang<type=Memory><HeapMemoryUsage>used", "jvm_memory_heap_used_bytes", "GAUGE"),
    Rule(
        r"java.lang<type=Memory><NonHeapMemoryUsage>used",
        "jvm_memory_nonheap_used_bytes",
        "GAUGE",
    ),
    Rule(
        r"java.lang<type=GarbageCollector, name=(.+)><>CollectionCount",
        "jvm_gc_collection_count",
        "COUNTER",
        {"gc": "$1"},
    ),
    Rule(
        r"java.lang<type=GarbageCollector, name=(.+)><>CollectionTime",
        "jvm_gc_collection_time_ms",
        "COUNTER",
        {"gc": "$1"},
    ),
)
# Exporter rules of a connector runtime, whose names end in ``attribute: value``.
CONNECT_RULES = (
    Rule(
        r"kafka.connect<type=connector-metrics, connector=(.+)><>connector-class:\s*(.+)",
        "kafka_connect_connector_info",
        "UNTYPED",
        {"connector": "$1", "connector_class": "$2"},
        "1",
    ),
    Rule(
        r"kafka.connect<type=connector-metrics, connector=(.+)><>"
        r"status:\s*(running|paused|failed|destroyed|unassigned)",
        "kafka_connect_connector_status",
        "UNTYPED",
        {"connector": "$1", "status": "$2"},
        "1",
    ),
    Rule(
        r"kafka.connect<type=connect-worker-metrics><>([a-z-]+):\s*([0-9.E+-]+)",
        "kafka_connect_worker_$1",
        "GAUGE",
        {},
        "$2",
    ),
    Rule(
        r"kafka.connect<type=connect-worker-metrics, connector=(.+)><>([a-z-]+):\s*([0-9.E+-]+)",
        "kafka_connect_worker_$2",
        "GAUGE",
        {"connector": "$1"},
        "$3",
    ),
    Rule(
        r"kafka.connect<type=connect-worker-rebalance-metrics><>([a-z-]+):\s*([0-9.E+-]+)",
        "kafka_connect_worker_rebalance_$1",
        "GAUGE",
        {},
        "$2",
    ),
    *[
        Rule(
            rf"kafka.connect<type={kind}-metrics, connector=(.+), task=(\d+)><>"
            r"([a-z-]+):\s*([0-9.E+-]+)",
            f"kafka_connect_{name}_$3",
            "GAUGE",
            {"connector": "$1", "task": "$2"},
            "$4",
        )
        for kind, name in (
            ("source-task", "source_task"),
            ("sink-task", "sink_task"),
            ("connector-task", "task"),
            ("task-error", "task_error"),
        )
    ],
    Rule(r"java.lang<type=Memory><HeapMemoryUsage>used", "jvm_memory_heap_used_bytes", "GAUGE"),
    Rule(r"java.lang<type=Memory><NonHeapMemoryUsage>used", "jvm_memory_nonheap_used_bytes", "GAUGE"),
    Rule(
        r"java.lang<name=(.+), type=GarbageCollector><>CollectionCount",
        "jvm_gc_collection_count",
        "COUNTER",
        {"gc": "$1"},
    ),
    Rule(r"java.lang<type=Threads><>ThreadCount", "jvm_threads_current", "GAUGE"),
)
BROKER_ADDRESS = r"kafka([0-9]+):.*"
# End of fixed values.


def _expand(raw: Column, pattern: str, template: str) -> Column:
    """The template with the groups of the first match filled in."""
    return F.regexp_replace(
        F.regexp_extract(raw, f"({pattern})", 1), pattern, template
    )


def _stated(raw: Column, rule: Rule) -> Column:
    told = F.lit(None) if rule.value is None else _expand(raw, rule.pattern, rule.value)
    return told.try_cast("double").alias("stated_value")


def relabel(
    df: DataFrame, raw: str = "raw_name", rules: tuple[Rule, ...] = BROKER_RULES
) -> DataFrame:
    """Adds ``metric``, ``labels`` and ``metric_type`` of the first rule that matches.

    Signs that no metric name may have become ``_``. With rules that tell values, the
    double ``stated_value`` is added too. Names without a rule keep null in all of them.
    """
    with_value = any(rule.value is not None for rule in rules)
    source = F.col(raw)
    outcome = None
    for rule in rules:
        labels = [
            part
            for label, template in rule.labels.items()
            for part in (F.lit(label), _expand(source, rule.pattern, template))
        ]
        built = F.struct(
            F.regexp_replace(
                F.lower(_expand(source, rule.pattern, rule.name)), "[^a-z0-9:_]", "_"
            ).alias("metric"),
            (F.create_map(*labels) if labels else F.create_map())
            .cast("map<string,string>")
            .alias("labels"),
            F.lit(rule.kind).alias("metric_type"),
            *([_stated(source, rule)] if with_value else []),
        )
        hit = source.rlike(rule.pattern)
        outcome = F.when(hit, built) if outcome is None else outcome.when(hit, built)
    return df.withColumn("_rule", outcome).select(*df.columns, "_rule.*")


def extract_label(source: Column, pattern: str, group: int = 1) -> Column:
    """Label taken from an address by a fully anchored pattern; null without a match."""
    found = F.regexp_extract(source, f"^(?:{pattern})$", group)
    return F.when(found != "", found)
