"""Stock reservation in arrival order.

An order takes its quantities if every one of its SKUs still has enough; otherwise
it takes nothing and later, smaller orders may still succeed. So the outcome of an
order depends on the outcomes of the earlier ones, SKU by SKU.

Arrival is a total order: time (or offset), log partition, offset, order. A release
counts if it comes after the request of its order, and the first one only; it then has
the verdict of the request, so an order's two entries together never add stock.

Orders that share no SKU, not even by way of others, do not touch each other: the SKUs
fall into groups, the connected components of the orders. A group of at most
``GROUP_ROWS`` entries is settled by one pass over its entries in order; a task passes over
many groups, one after the other. The stock of a group comes first among its rows, so the
entries are shuffled once, by group, where no order has several SKUs.

Larger groups are settled in rounds over all their SKUs at once. For every undecided order
two running totals per SKU bound what earlier orders have taken: only those already
accepted (least), and those plus all undecided ones (most). Enough stock under the
most means accepted; too little under the least means refused. The earliest
undecided order has equal bounds, so every round decides something, and in practice
the greater part. A round reads only what is still open, with what it knows to be taken,
and what the round before accepted, so each entry is moved in as many rounds as it
stays open. The totals run in chunks, so a hot SKU is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import components
from millrace.operators.running import OFFSETS_PER_CHUNK, Running, offset_chunk, running
from millrace.runtime import stored, work_folder

RESERVED = "StockReserved"
OUT_OF_STOCK = "StockOutOfStock"
#: Entries of a group that one task settles in order: they stream through, so what a task
#: holds is a number for each SKU and the accepted orders of one group.
GROUP_ROWS = 3_000_000
# Width of a chunk where places are times in microseconds.
MICROS_PER_CHUNK = 6 * 3600 * 1_000_000

_PLACE = ["at", "partition", "offset"]
_ORDER = [*_PLACE, "order_id", "kind"]
REQUEST, RELEASE, RETURNED = "request", "release", "returned"
# The kinds in the order of their names, behind the opening stock.
_STOCK, _RELEASE, _REQUEST, _RETURNED = range(4)
_BEFORE_ALL = -(1 << 62)


def _placed(df: DataFrame) -> DataFrame:
    """``df`` with all three columns of its place; the offset stands for a missing time."""
    if "at" not in df.columns:
        df = df.withColumn("at", F.col("offset"))
    if "partition" not in df.columns:
        df = df.withColumn("partition", F.lit(0))
    return df.withColumns({c: F.col(c).cast("bigint") for c in _PLACE})


def demands_of_paid_orders(events: DataFrame, at: Column | None = None) -> DataFrame:
    """Lines to reserve: items of the created order, at the place of its first payment.

    ``at`` is the arrival as a whole number, say microseconds; without it the offset
    orders the events of all log partitions. One aggregate per order brings both events
    together.
    """
    kind = F.col("event_type")
    events = _placed(events if at is None else events.withColumn("at", at))
    place = F.struct(*_PLACE)
    per_order = (
        events.filter(kind.isin("OrderCreated", "PaymentCompleted"))
        .groupBy("order_id")
        .agg(
            F.min_by("items", F.when(kind == "OrderCreated", place)).alias("items"),
            F.min(F.when(kind == "PaymentCompleted", place)).alias("place"),
        )
        .filter(F.col("items").isNotNull() & F.col("place").isNotNull())
    )
    return per_order.select(
        "order_id", "place.*", F.posexplode("items").alias("line_no", "item")
    ).select("order_id", *_PLACE, "line_no", "item.sku", "item.quantity")


def reserve(
    demands: DataFrame,
    stock: DataFrame,
    releases: DataFrame | None = None,
    at_per_chunk: int = OFFSETS_PER_CHUNK,
    returned: DataFrame | None = None,
    store: bool = True,
) -> DataFrame:
    """``order_id, offset, event_type, missing_sku`` for every order.

    ``demands``: order_id, its place, line_no, sku, quantity > 0. ``stock``: sku,
    quantity. ``releases``: order_id and the places at which a cancelled order gives
    back what it had reserved. ``returned``: order_id, place, sku and quantity that come
    back from orders decided before. A place is ``at, partition, offset``, or ``offset`` alone.
    All of these are read three times or more, and so stored once, unless not to ``store`` them
    costs less: they are then stored tables already, little more than read.
    """
    lines = _placed(demands).withColumn("delta", F.coalesce(F.col("quantity").cast("bigint"), F.lit(0)))
    columns = ["sku", *_PLACE, "order_id", "line_no", "delta", "kind"]
    entries = lines.withColumn("kind", F.lit(REQUEST)).select(columns)
    if releases is not None:
        entries = entries.unionByName(_given_back(lines, _placed(releases)).select(columns))
    if returned is not None:
        back = _placed(returned).withColumns(
            {"delta": (-F.col("quantity")).cast("bigint"), "kind": F.lit(RETURNED), "line_no": F.lit(None).cast("int")}
        )
        entries = entries.unionByName(back.select(columns))
    entries = entries.filter(F.col("sku").isNotNull())
    if store:
        entries = stored(entries, "stock-entries")

    groups = _groups(entries)

    def grouped(df: DataFrame) -> DataFrame:
        """``df`` with ``g``, the group of its SKU."""
        if groups is None:
            return df.withColumn("g", F.col("sku"))
        return df.join(groups, "sku", "left").withColumn("g", F.coalesce("component", "sku")).drop("component")

    quantities = grouped(
        stock.select(
            F.col("sku").cast(entries.schema["sku"].dataType).alias("sku"), F.col("quantity").cast("bigint").alias("quantity")
        )
    )
    sizes = grouped(entries.groupBy("sku").agg(F.count("*").alias("_n"))).groupBy("g").agg(F.sum("_n").alias("n"))
    # A row for each GROUP_ROWS entries at most.
    large = stored(sizes.filter(F.col("n") > GROUP_ROWS).select("g"), "stock-large")
    entries = grouped(entries)
    if large.isEmpty():
        return _in_order(entries, quantities, demands.schema)
    large = F.broadcast(large)
    outcomes = _in_order(
        entries.join(large, "g", "left_anti"), quantities.join(large, "g", "left_anti"), demands.schema
    )
    # Two lines of one SKU ask for their sum.
    theirs = entries.join(large, "g", "left_semi").groupBy("sku", *_PLACE, "order_id", "kind").agg(
        F.sum("delta").alias("delta"), F.min("line_no").alias("line_no")
    )
    balances = quantities.join(large, "g", "left_semi").drop("g")
    return outcomes.unionByName(_in_rounds(theirs.select(columns), balances, at_per_chunk))


def movements(
    demands: DataFrame, releases: DataFrame, decided: DataFrame, returned: DataFrame | None = None
) -> DataFrame:
    """``order_id, sku, quantity``: what accepted orders took, and below zero what came back."""
    accepted = decided.filter(F.col("event_type") == RESERVED).select("order_id").distinct()
    lines = _placed(demands).groupBy("order_id", *_PLACE, "sku").agg(
        F.sum("quantity").cast("bigint").alias("delta"), F.min("line_no").alias("line_no")
    )
    moved = lines.select("order_id", "sku", "delta").unionByName(
        _given_back(lines, _placed(releases)).select("order_id", "sku", "delta")
    )
    out = moved.join(accepted, "order_id", "left_semi").withColumnRenamed("delta", "quantity")
    if returned is not None:
        out = out.unionByName(returned.select("order_id", "sku", (-F.col("quantity")).alias("quantity")))
    return out


def _groups(entries: DataFrame) -> DataFrame | None:
    """``sku, component`` of the SKUs that orders link to others; None if no order does."""
    asked = entries.filter(F.col("kind") == REQUEST)
    first = asked.groupBy("order_id").agg(F.min("sku").alias("a"), F.max("sku").alias("_last"))
    several = stored(first.filter("a <> _last").select("order_id", "a"), "stock-several")
    if several.isEmpty():
        return None
    links = asked.join(several, "order_id").filter("sku <> a").select("a", F.col("sku").alias("b")).distinct()
    return components(links).withColumnRenamed("node", "sku")


def _in_order(entries: DataFrame, stock: DataFrame, types) -> DataFrame:
    """Outcomes of small groups, each by one pass over its entries."""
    names = ["g", *_ORDER, "sku", "delta", "line_no"]

    def values(column: pa.Array) -> list:
        """The values of a column; whole numbers take the short way, by numpy."""
        if not pa.types.is_integer(column.type):
            return column.to_pylist()
        found = column.fill_null(0).to_numpy().tolist()
        if column.null_count:
            for i in np.flatnonzero(column.is_null().to_numpy(zero_copy_only=False)):
                found[i] = None
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # ``now``: place, order, kind and group that the lines in ``asked`` belong to.
        now, asked, left, held = (None,) * 6, {}, {}, set()
        orders, offsets, missing = [], [], []

        def settle() -> None:
            order, kind = now[3], now[4]
            if kind == _REQUEST:
                lacking = [(line, sku) for sku, (delta, line) in asked.items() if left.get(sku, 0) < delta]
                orders.append(order)
                offsets.append(now[2])
                missing.append(min(lacking)[1] if lacking else None)
                if lacking:
                    return
                held.add(order)
            elif kind == _RELEASE and order not in held:
                return
            else:
                held.discard(order)
            for sku, (delta, _) in asked.items():
                left[sku] = left.get(sku, 0) - delta

        def rows() -> pa.RecordBatch:
            events = [RESERVED if sku is None else OUT_OF_STOCK for sku in missing]
            columns = zip((orders, offsets, events, missing), kinds)
            return pa.record_batch(
                [pa.array(c, t) for c, t in columns], ["order_id", "offset", "event_type", "missing_sku"]
            )

        kinds: list[pa.DataType] = []
        for batch in batches:
            at = dict(zip(batch.schema.names, batch.columns))
            kinds = [at["order_id"].type, pa.int64(), pa.string(), at["sku"].type]
            columns = [values(at[c]) for c in names]
            for g, when, partition, offset, order, kind, sku, delta, line in zip(*columns):
                entry = (when, partition, offset, order, kind, g)
                if entry != now:
                    if asked:
                        settle()
                        asked = {}
                    if g != now[5]:
                        left, held = {}, set()
                    now = entry
                if kind == _STOCK:
                    left[sku] = left.get(sku, 0) + (delta or 0)
                elif sku in asked:
                    # Two lines of one SKU ask for their sum; the first one names it.
                    before = asked[sku]
                    asked[sku] = (before[0] + delta, line if before[1] is None else before[1])
                else:
                    asked[sku] = (delta, line)
            if len(orders) > 1 << 14:
                yield rows()
                orders, offsets, missing = [], [], []
        if asked:
            settle()
        if orders:
            yield rows()

    kind = {f.name: f.dataType.simpleString() for f in types}
    code = F.when(F.col("kind") == RELEASE, _RELEASE).when(F.col("kind") == REQUEST, _REQUEST).otherwise(_RETURNED)
    opening = stock.select(
        "g", *[F.lit(_BEFORE_ALL).cast("bigint").alias(c) for c in _PLACE],
        F.lit(None).cast(entries.schema["order_id"].dataType).alias("order_id"), F.lit(_STOCK).alias("kind"),
        "sku", F.col("quantity").alias("delta"), F.lit(0).cast(entries.schema["line_no"].dataType).alias("line_no"),
    )
    every = entries.withColumn("kind", code).select(names).unionByName(opening)
    ordered = every.repartition("g").sortWithinPartitions("g", F.col("kind") != _STOCK, *_ORDER, "line_no")
    return ordered.mapInArrow(
        run, f"order_id {kind['order_id']}, offset bigint, event_type string, missing_sku {kind['sku']}"
    )


def _in_rounds(entries: DataFrame, stock: DataFrame, at_per_chunk: int) -> DataFrame:
    """Outcomes of large groups, by bounds on what earlier orders took."""
    spark = entries.sparkSession
    folder = work_folder(spark, "stock")
    zero = F.lit(0).cast("bigint")
    opening = stock.select(
        "sku",
        *[F.lit(_BEFORE_ALL).cast("bigint").alias(c) for c in _PLACE],
        F.lit(None).cast(entries.schema["order_id"].dataType).alias("order_id"),
        F.lit(None).cast("int").alias("line_no"),
        (-F.col("quantity")).alias("delta"),
        F.lit("stock").alias("kind"),
    )
    known = F.when(F.col("kind") == RETURNED, "fixed").otherwise("open")
    entries = entries.withColumns({"least": zero, "status": known}).unionByName(
        opening.withColumns({"least": zero, "status": F.lit("fixed")})
    )

    # Every round and the outcomes read the entries again, so they are stored once.
    entries.write.parquet(f"{folder}/entries")
    entries = spark.read.schema(entries.schema).parquet(f"{folder}/entries")
    lines = entries.filter(F.col("kind") == REQUEST).drop("kind", "status", "least")

    now, accepted, round_no = entries, entries.filter(F.col("status") == "fixed"), 0
    while True:
        table = f"{folder}/round={round_no}"
        _settled(_with_bounds(now, at_per_chunk)).write.partitionBy("status").parquet(table)
        after = spark.read.schema(now.schema).parquet(table)
        accepted = accepted.unionByName(after.filter(F.col("status") == "fixed"))
        if after.filter(F.col("status") == "open").isEmpty():
            break
        now = after.filter(F.col("status").isin("open", "fixed"))
        round_no += 1

    return _outcomes(lines, stored(accepted, "stock-accepted"), at_per_chunk)


def _given_back(lines: DataFrame, releases: DataFrame) -> DataFrame:
    """Entries of the first release of each order after its request."""
    own = lines.groupBy("order_id").agg(F.min(F.struct(*_PLACE)).alias("_asked"))
    first = (
        releases.join(own, "order_id")
        .filter(F.struct(*_PLACE) > F.col("_asked"))
        .groupBy("order_id")
        .agg(F.min(F.struct(*_PLACE)).alias("_place"))
        .select("order_id", "_place.*")
    )
    return lines.drop(*_PLACE).join(first, "order_id").select(
        "sku", *_PLACE, "order_id", "line_no",
        (-F.col("delta")).alias("delta"), F.lit(RELEASE).alias("kind"),
    )


def _with_bounds(entries: DataFrame, at_per_chunk: int) -> DataFrame:
    """Least and most taken from each SKU before each entry, opening stock deducted.

    ``least`` of an open entry already has what earlier rounds accepted; the entries
    that the last round accepted, status fixed, are added to it here.
    """
    zero = F.lit(0).cast("bigint")
    fixed = F.col("status") == "fixed"
    totals = running(
        entries,
        ["sku"],
        _ORDER,
        offset_chunk(F.col("at"), at_per_chunk),
        Running(
            sums={
                "_new": F.when(fixed, F.col("delta")).otherwise(zero),
                "_open": F.when(fixed, zero).otherwise(F.col("delta")),
            }
        ),
    )
    least = F.col("least") + F.col("_new")
    return (
        totals.filter(~fixed)
        .withColumn("least", least)
        .withColumn("most", F.col("least") + F.col("_open") - F.col("delta"))
        .drop("_new", "_open")
    )


def _settled(bounded: DataFrame) -> DataFrame:
    """Open entries with the status they have after this round."""
    verdicts = (
        bounded.filter(F.col("kind") == REQUEST)
        .groupBy("order_id")
        .agg(
            F.bool_and(F.col("most") + F.col("delta") <= 0).alias("_sure"),
            F.bool_or(F.col("least") + F.col("delta") > 0).alias("_lacking"),
        )
        .select(
            "order_id",
            F.when(F.col("_sure"), "fixed")
            .when(F.col("_lacking"), "refused")
            .otherwise("open")
            .alias("status"),
        )
    )
    return bounded.drop("status", "most").join(verdicts, "order_id").select(
        "sku", *_PLACE, "order_id", "line_no", "delta", "kind", "least", "status"
    )


def _outcomes(lines: DataFrame, fixed: DataFrame, at_per_chunk: int) -> DataFrame:
    """Events of all orders; refused ones name the first line that lacked stock.

    The refused lines join the accepted entries with a zero quantity, so one running
    total tells what was left when each of them was looked at.
    """
    accepted = fixed.filter(F.col("kind") == REQUEST).select("order_id").distinct()
    refused = lines.join(accepted, "order_id", "left_anti")
    asked = refused.select(
        "sku", *_PLACE, "order_id", "line_no", F.lit(REQUEST).alias("kind"),
        F.col("delta").alias("_asked"), F.lit(0).cast("bigint").alias("delta"),
    )
    taken = fixed.select(
        "sku", *_PLACE, "order_id", "line_no", "kind",
        F.lit(None).cast("bigint").alias("_asked"), "delta",
    )
    looked_at = running(
        taken.unionByName(asked),
        ["sku"],
        _ORDER,
        offset_chunk(F.col("at"), at_per_chunk),
        Running(sums={"_taken": F.col("delta")}),
    )
    missing = (
        looked_at.filter(F.col("_asked").isNotNull())
        .groupBy("order_id", "offset")
        .agg(
            F.min_by(
                "sku",
                F.when(
                    F.col("_taken") + F.col("_asked") > 0, F.struct("line_no", "sku")
                ),
            ).alias("missing_sku")
        )
        .withColumn("event_type", F.lit(OUT_OF_STOCK))
    )
    reserved = (
        fixed.filter(F.col("kind") == REQUEST)
        .groupBy("order_id", "offset")
        .agg(F.lit(RESERVED).alias("event_type"))
    )
    return reserved.unionByName(missing, allowMissingColumns=True).select(
        "order_id", "offset", "event_type", "missing_sku"
    )
