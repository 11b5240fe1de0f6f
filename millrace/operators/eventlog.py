"""State of orders as a fold over their events."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.counts import orders_by_day_and_status
from millrace.operators.dedup import once_per_event
from millrace.operators.latest import latest_per_key
from millrace.operators.running import OFFSETS_PER_CHUNK, Running, offset_chunk, running
from millrace.sources.bounded import end_offsets, read_until

# Status reached by an event, and the fields that tell events apart.
STATUS_AFTER = {
    "OrderCreated": "CREATED",
    "PaymentCompleted": "PAID",
    "StockReserved": "RESERVED",
    "OrderShipped": "SHIPPED",
    "OrderDelivered": "DELIVERED",
    "OrderCancelled": "CANCELLED",
}
TYPE_BY_FIELD = {
    "items": "OrderCreated",
    "transaction_id": "PaymentCompleted",
    "missing_sku": "StockOutOfStock",
    "tracking_number": "OrderShipped",
    "delivered_at": "OrderDelivered",
    "reservation_id": "Ambiguous:StockReserved/StockReleased",
    "reason": "Ambiguous:PaymentFailed/OrderCancelled",
}
SNAPSHOT_EVERY = 5
HAPPY_PATH = ("OrderCreated", "PaymentCompleted", "StockReserved", "OrderShipped")
DEFAULT_CURRENCY = "EUR"
# End of fixed values.

PLACE = ("partition", "offset")
#: Offsets before the end of a log partition beyond which no event waits for a snapshot.
TAIL_OFFSETS = 1_000_000
MARKS = "run INT, partition INT, low BIGINT"
ATTRIBUTES = (
    "status",
    "customer_id",
    "total",
    "currency",
    "transaction_id",
    "reservation_id",
    "tracking_number",
    "cancel_reason",
)


def classified(events: DataFrame) -> DataFrame:
    """Events with a type: the stated one, otherwise the one their fields tell.

    Two pairs of events look alike; those stay marked as ambiguous.
    """
    guess = None
    for name, kind in TYPE_BY_FIELD.items():
        present = F.col(name).isNotNull()
        guess = F.when(present, kind) if guess is None else guess.when(present, kind)
    if "event_type" in events.columns:
        guess = F.coalesce(F.col("event_type"), guess)
    return events.withColumn("event_type", guess)


def _lookup(table: dict[str, str], key: Column) -> Column:
    chosen = None
    for name, value in table.items():
        hit = key == name
        chosen = F.when(hit, value) if chosen is None else chosen.when(hit, value)
    return chosen


def contributions(events: DataFrame) -> DataFrame:
    """What each event sets; null where it leaves an attribute as it was."""

    def of(kind: str, column: str) -> Column:
        return F.when(F.col("event_type") == kind, F.col(column))

    return events.select(
        "order_id",
        *PLACE,
        "version",
        "occurred_at",
        _lookup(STATUS_AFTER, F.col("event_type")).alias("status"),
        of("OrderCreated", "customer_id").alias("customer_id"),
        of("OrderCreated", "total").alias("total"),
        of("OrderCreated", "currency").alias("currency"),
        of("PaymentCompleted", "transaction_id").alias("transaction_id"),
        of("StockReserved", "reservation_id").alias("reservation_id"),
        of("OrderShipped", "tracking_number").alias("tracking_number"),
        of("OrderCancelled", "reason").alias("cancel_reason"),
    )


def _with_defaults(states: DataFrame) -> DataFrame:
    return states.fillna(
        {"status": "CREATED", "customer_id": "", "total": 0.0, "currency": DEFAULT_CURRENCY}
    )


def fold_contributions(rows: DataFrame, with_place: bool = False) -> DataFrame:
    place = F.struct(*PLACE)
    places = [F.max(place)[c].alias(c) for c in PLACE] if with_place else []
    return _with_defaults(
        rows.groupBy("order_id").agg(
            *places,
            F.max_by("version", place).alias("version"),
            F.max_by("occurred_at", place).alias("occurred_at"),
            *[
                F.max_by(a, F.when(F.col(a).isNotNull(), place)).alias(a)
                for a in ATTRIBUTES
            ],
        )
    )


def fold(events: DataFrame) -> DataFrame:
    """State of every order: the last value of each attribute in arrival order.

    An aggregate with a partial step, so long orders shrink before the shuffle.
    """
    return fold_contributions(contributions(events))


def at_version(events: DataFrame, version: int) -> DataFrame:
    """States as they were once ``version`` was reached."""
    return fold(events.filter(F.col("version") <= version))


def replay_order(log: DataFrame, order_id: object) -> DataFrame:
    """State of one order from the log as it stands now, each event counted once."""
    own = read_until(log, end_offsets(log)).filter(F.col("order_id") == F.lit(order_id))
    return fold(once_per_event(own))


def snapshots(
    events: DataFrame,
    every: int = SNAPSHOT_EVERY,
    offsets_per_chunk: int = OFFSETS_PER_CHUNK,
    since: DataFrame | None = None,
) -> DataFrame:
    """State of an order after each ``every``-th of its events.

    ``since``: the last snapshot of orders whose earlier events are no longer read; its
    version is the number of events it stands for.
    """
    one = F.lit(1).cast("bigint")
    rows = contributions(events).withColumn("_events", one)
    if since is not None:
        seen = since.withColumnRenamed("snapshot_at", "occurred_at")
        rows = rows.withColumn("_old", F.lit(False)).unionByName(
            seen.withColumns({"_events": F.col("version").cast("bigint"), "_old": F.lit(True)})
        )
    else:
        rows = rows.withColumn("_old", F.lit(False))
    spec = Running(
        sums={"_n": F.col("_events")},
        lasts={f"_{a}": F.col(a) for a in ATTRIBUTES},
    )
    chunk = F.struct("partition", offset_chunk(F.col("offset"), offsets_per_chunk))
    folded = running(rows, ["order_id"], list(PLACE), chunk, spec)
    return _with_defaults(
        folded.filter((F.col("_n") % every == 0) & ~F.col("_old")).select(
            "order_id",
            *PLACE,
            "version",
            F.col("occurred_at").alias("snapshot_at"),
            *[F.col(f"_{a}").alias(a) for a in ATTRIBUTES],
        )
    )


def bootstrap(snapshot_log: DataFrame, events: DataFrame) -> DataFrame:
    """States from the latest snapshots and the events after them.

    A snapshot stands for all events up to its place, so it enters the fold as one
    row at that place. Events before it change nothing and may be left out by the
    reader. There is no join, hence no hot join key.
    """
    last = latest_per_key(snapshot_log, ["order_id"], list(PLACE))
    as_rows = last.withColumnRenamed("snapshot_at", "occurred_at")
    return fold_contributions(contributions(events).unionByName(as_rows))


def _open_events(events: DataFrame, last: DataFrame) -> DataFrame:
    """Events that no snapshot of their order stands for."""
    covered = last.select("order_id", F.struct(*PLACE).alias("_covered"))
    place = F.struct(*PLACE)
    rows = events.join(covered, "order_id", "left")
    return rows.filter(F.col("_covered").isNull() | (place > F.col("_covered"))).drop("_covered")


def write_snapshots(
    log: DataFrame, folder: str, every: int = SNAPSHOT_EVERY, keep: int = TAIL_OFFSETS
) -> dict[int, int]:
    """Stores snapshots and, for each log partition, the offset from which the log is
    still needed; returns these marks.

    A run reads the tail that the run before it left over, and its snapshots. Orders whose
    first event without a snapshot lies more than ``keep`` offsets before the end of the
    log get a snapshot now, so that a quiet order does not hold the marks back. A run
    counts once its marks are stored; one that failed is replaced.
    """
    spark = log.sparkSession
    runs, marks = stored_marks(spark, folder)
    tail = tail_of(log, marks)
    ends = {**marks, **end_offsets(tail)}
    home = f"{folder}/run={runs + 1}"
    earlier = stored_snapshots(spark, folder, runs)
    last = latest_per_key(earlier, ["order_id"], list(PLACE)) if runs else None
    events = tail if last is None else _open_events(tail, last)
    # The last snapshot of an order that has further events is where its counting goes on.
    since = None if last is None else last.join(events.select("order_id").distinct(), "order_id", "left_semi")
    snapshots(events, every, since=since).write.mode("overwrite").parquet(f"{home}/regular")
    regular = spark.read.parquet(f"{home}/regular")

    now = regular if last is None else regular.unionByName(last)
    left_over = _open_events(events, latest_per_key(now, ["order_id"], list(PLACE)))
    behind = F.lit(False)
    for partition, end in sorted(ends.items()):
        behind = behind | ((F.col("partition") == partition) & (F.col("offset") < end - keep))
    quiet = left_over.groupBy("order_id").agg(F.bool_or(behind).alias("_behind")).filter("_behind").drop("_behind")
    known = now.withColumnRenamed("snapshot_at", "occurred_at").join(quiet, "order_id", "left_semi")
    theirs = contributions(left_over).join(quiet, "order_id", "left_semi").unionByName(known)
    closing = fold_contributions(theirs, with_place=True).withColumnRenamed("occurred_at", "snapshot_at")
    closing.select(regular.columns).write.mode("overwrite").parquet(f"{home}/closing")

    needed = left_over.join(quiet, "order_id", "left_anti").groupBy("partition").agg(F.min("offset").alias("low"))
    found = {**ends, **{r["partition"]: r["low"] for r in needed.collect()}}
    rows = [(runs + 1, p, low) for p, low in sorted(found.items())]
    stored_now = spark.createDataFrame(rows, MARKS).coalesce(1)
    stored_now.write.mode("overwrite").parquet(f"{home}/marks")
    return found


def stored_marks(spark: SparkSession, folder: str) -> tuple[int, dict[int, int]]:
    """Number of the last complete run and its marks by log partition."""
    try:
        rows = spark.read.schema(MARKS).parquet(f"{folder}/run=*/marks").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    run = max((r["run"] for r in rows), default=0)
    return run, {r["partition"]: r["low"] for r in rows if r["run"] == run}


def stored_snapshots(spark: SparkSession, folder: str, runs: int) -> DataFrame | None:
    """Snapshots of all complete runs."""
    paths = [f"{folder}/run={r}/{kind}" for r in range(1, runs + 1) for kind in ("regular", "closing")]
    return spark.read.parquet(*paths) if paths else None


def tail_of(log: DataFrame, marks: dict[int, int]) -> DataFrame:
    """Events from the marks on, and all of log partitions without one. The marks are
    literals, so the scan skips what lies before them."""
    if not marks:
        return log
    wanted = ~F.col("partition").isin(*marks)
    for partition, low in sorted(marks.items()):
        wanted = wanted | ((F.col("partition") == partition) & (F.col("offset") >= low))
    return log.filter(wanted)


def bootstrap_stored(folder: str, log: DataFrame) -> DataFrame:
    """States from the stored snapshots and the tail of the log that they do not cover."""
    runs, marks = stored_marks(log.sparkSession, folder)
    if not runs:
        return fold(log)
    return bootstrap(stored_snapshots(log.sparkSession, folder, runs), tail_of(log, marks))


def saga_paths(events: DataFrame, path: tuple[str, ...] = HAPPY_PATH) -> DataFrame:
    """Per order: the first place of each expected event and whether they are in order."""
    place = F.struct(*PLACE)
    firsts = events.groupBy("order_id").agg(
        *[F.min(F.when(F.col("event_type") == kind, place)).alias(kind) for kind in path]
    )
    complete = F.lit(True)
    ordered = F.lit(True)
    for kind in path:
        complete = complete & F.col(kind).isNotNull()
    for earlier, later in zip(path, path[1:]):
        ordered = ordered & F.coalesce(F.col(earlier) < F.col(later), F.lit(False))
    return firsts.select(
        "order_id",
        *[F.col(kind)["offset"].alias(f"first_{kind}") for kind in path],
        complete.alias("complete"),
        ordered.alias("in_order"),
    )


def version_gaps(events: DataFrame) -> DataFrame:
    """Orders whose versions are not exactly 1..n: missing or repeated numbers."""
    stats = events.groupBy("order_id").agg(
        F.count("*").alias("n_events"),
        F.min("version").alias("first_version"),
        F.max("version").alias("last_version"),
        F.countDistinct("version").alias("n_versions"),
    )
    whole = (
        (F.col("first_version") == 1)
        & (F.col("last_version") == F.col("n_events"))
        & (F.col("n_versions") == F.col("n_events"))
    )
    return stats.filter(~whole)


def daily_dashboard(events: DataFrame) -> DataFrame:
    return orders_by_day_and_status(fold(events))
