"""Decisions of the order saga as DataFrame operators over the event log.

Ids are hashes of the order, so a job that runs again decides the same events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.rules import strict_variant
from millrace.functions.shaping import items_total
from millrace.operators.dedup import first_per_key
from millrace.schemas import MONEY, PLACE_ORDER

# Limits, reasons and names used in the decisions.
MAX_AMOUNT = 1000.0
CANCEL_REASONS = {"PaymentFailed": "payment_failed", "StockOutOfStock": "out_of_stock"}
RELEASE_PREFIX = "released-"
CARRIER = "UPS"
DELIVERY_DELAY_SECONDS = 2
COMMAND_TYPE = "PlaceOrder"
NEXT_COMMAND = {
    "CREATED": "ChargePayment",
    "PAID": "ReserveStock",
    "RESERVED": "ShipOrder",
}
# End of fixed values.


def stable_id(kind: str, *parts: str | Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(kind), *parts), 256)


def parse_commands(messages: DataFrame, value: str = "value") -> DataFrame:
    """``command`` where the payload is a whole PlaceOrder, else ``error_message``.

    A bad command is a row like any other, so progress past it is kept.
    """
    command = F.from_json(F.col(value).cast("string"), PLACE_ORDER, {"mode": "PERMISSIVE"})
    parsed = messages.withColumn("command", command)
    item_ok = F.forall(
        F.col("command.items"),
        lambda i: i["sku"].isNotNull()
        & i["quantity"].isNotNull()
        & i["unit_price"].isNotNull(),
    )
    stated = F.coalesce(F.col("command.command_type"), F.lit(COMMAND_TYPE))
    whole = strict_variant(F.col(value).cast("string"))
    customer = F.schema_of_variant(F.try_variant_get(whole, "$.customer_id", "variant"))
    error = (
        F.when(whole.isNull(), "unreadable")
        .when(stated != COMMAND_TYPE, "unknown_command")
        .when(F.col("command.customer_id").isNull(), "missing:customer_id")
        .when(customer != "STRING", "invalid:customer_id")
        .when(F.col("command.items").isNull(), "missing:items")
        .when(~F.coalesce(item_ok, F.lit(False)), "invalid:items")
    )
    return parsed.withColumn("error_message", error)


def accepted_commands(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error_message").isNull())


def rejected_commands(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("error_message").isNotNull()).drop("command")


def orders_created(commands: DataFrame, occurred_at: Column | None = None) -> DataFrame:
    """Accepted PlaceOrder commands as OrderCreated events, version 1."""
    order_id = F.coalesce(F.col("command.order_id"), stable_id("order", F.col("value").cast("string")))
    return commands.select(
        stable_id("OrderCreated", order_id).alias("event_id"),
        order_id.alias("order_id"),
        (F.current_timestamp() if occurred_at is None else occurred_at).alias("occurred_at"),
        F.lit(1).alias("version"),
        F.lit("OrderCreated").alias("event_type"),
        F.col("command.customer_id").alias("customer_id"),
        F.col("command.items").alias("items"),
        items_total(F.col("command.items")).alias("total"),
        F.coalesce(F.col("command.currency"), F.lit("EUR")).alias("currency"),
    )


def payment_decisions(events: DataFrame, max_amount: float = MAX_AMOUNT) -> DataFrame:
    """One payment event per created order, however often its event was delivered."""
    first = first_per_key(
        events.filter(F.col("event_type") == "OrderCreated"), ["order_id"]
    )
    total = F.coalesce(F.col("total").cast(MONEY), F.lit(0).cast(MONEY))
    accepted = total <= F.lit(max_amount).cast(MONEY)
    kind = F.when(accepted, "PaymentCompleted").otherwise("PaymentFailed")
    reason = F.concat(
        F.lit("amount "),
        # As a float is written: at least one decimal, no trailing zero after it.
        F.regexp_replace(total.cast("string"), r"(\.\d)0$", "$1"),
        F.lit(f" exceeds {max_amount}"),
    )
    return first.select(
        stable_id("Payment", "order_id").alias("event_id"),
        "order_id",
        (F.col("version") + 1).alias("version"),
        kind.alias("event_type"),
        F.when(accepted, stable_id("transaction", "order_id")).alias("transaction_id"),
        F.when(accepted, total).alias("amount"),
        F.when(~accepted, reason).alias("reason"),
    )


def cancellations(events: DataFrame) -> DataFrame:
    """OrderCancelled for a failed payment or missing stock.

    The rule looks at the event type, so a cancellation does not cancel again.
    """
    kind = F.col("event_type")
    reason = None
    for name, text in CANCEL_REASONS.items():
        reason = F.when(kind == name, text) if reason is None else reason.when(kind == name, text)
    return events.filter(kind.isin(*CANCEL_REASONS)).select(
        stable_id("OrderCancelled", "event_id").alias("event_id"),
        "order_id",
        (F.col("version") + 1).alias("version"),
        F.lit("OrderCancelled").alias("event_type"),
        reason.alias("reason"),
    )


def compensations(events: DataFrame, refunds: bool = False) -> DataFrame:
    """StockReleased for every cancelled order that holds a reservation.

    With ``refunds``, also PaymentRefunded for a cancelled order that was paid. One
    aggregate per order finds both, without joining the log to itself.
    """
    place = F.struct("partition", "offset")

    def first(kind: str) -> Column:
        return F.min(F.when(F.col("event_type") == kind, place))

    wanted = ["StockReserved", "PaymentCompleted", "OrderCancelled"]
    facts = (
        events.filter(F.col("event_type").isin(*wanted))
        .groupBy("order_id")
        .agg(
            F.min_by(
                "version", F.when(F.col("event_type") == "OrderCancelled", place)
            ).alias("_version"),
            first("OrderCancelled").alias("_cancelled"),
            first("StockReserved").alias("_reserved"),
            first("PaymentCompleted").alias("_paid"),
        )
        .filter(F.col("_cancelled").isNotNull())
    )
    release = F.when(
        F.col("_reserved") < F.col("_cancelled"),
        F.struct(
            F.lit("StockReleased").alias("event_type"),
            F.concat(F.lit(RELEASE_PREFIX), F.col("order_id")).alias("reservation_id"),
        ),
    )
    refund = F.when(
        (F.col("_paid") < F.col("_cancelled")) & F.lit(refunds),
        F.struct(
            F.lit("PaymentRefunded").alias("event_type"),
            F.lit(None).cast("string").alias("reservation_id"),
        ),
    )
    return facts.select(
        "order_id",
        (F.col("_version") + 1).alias("version"),
        F.explode(F.array_compact(F.array(release, refund))).alias("_event"),
    ).select(
        stable_id("compensation", "_event.event_type", "order_id").alias("event_id"),
        "order_id",
        "version",
        "_event.*",
    )


def shipments(events: DataFrame) -> DataFrame:
    """OrderShipped and, two seconds later, OrderDelivered for each reservation."""
    tracking = F.concat(
        F.lit("TRK-"), F.upper(F.substring(stable_id("tracking", "order_id"), 1, 10))
    )
    at = F.col("occurred_at")
    later = F.timestamp_add("SECOND", F.lit(DELIVERY_DELAY_SECONDS), at)
    shipped = F.struct(
        F.lit("OrderShipped").alias("event_type"),
        F.lit(1).alias("step"),
        at.alias("occurred_at"),
        tracking.alias("tracking_number"),
        F.lit(CARRIER).alias("carrier"),
        F.lit(None).cast(later_type(events)).alias("delivered_at"),
    )
    delivered = F.struct(
        F.lit("OrderDelivered").alias("event_type"),
        F.lit(2).alias("step"),
        later.alias("occurred_at"),
        F.lit(None).cast("string").alias("tracking_number"),
        F.lit(None).cast("string").alias("carrier"),
        later.alias("delivered_at"),
    )
    return (
        events.filter(F.col("event_type") == "StockReserved")
        .select("order_id", "event_id", "version", F.explode(F.array(shipped, delivered)).alias("_e"))
        .select(
            stable_id("shipping", "_e.event_type", "event_id").alias("event_id"),
            "order_id",
            (F.col("version") + F.col("_e.step")).alias("version"),
            "_e.event_type",
            "_e.occurred_at",
            "_e.tracking_number",
            "_e.carrier",
            "_e.delivered_at",
        )
    )


def later_type(events: DataFrame):
    return events.schema["occurred_at"].dataType


def next_commands(states: DataFrame) -> DataFrame:
    """Commands an orchestrator would send next, from the current states.

    A cancelled order gives back what it still holds: its payment, its stock, or both.
    """
    forward = None
    for status, command in NEXT_COMMAND.items():
        hit = F.col("status") == status
        forward = F.when(hit, command) if forward is None else forward.when(hit, command)
    cancelled = F.col("status") == "CANCELLED"
    commands = F.array_compact(
        F.array(
            forward,
            F.when(cancelled & F.col("transaction_id").isNotNull(), "RefundPayment"),
            F.when(cancelled & F.col("reservation_id").isNotNull(), "ReleaseStock"),
        )
    )
    return states.select("order_id", "version", "status", F.explode(commands).alias("command"))
