"""Schemas shared by sources, operators and tests."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


_TYPES = {
    "STRING": T.StringType(),
    "BINARY": T.BinaryType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "MONEY": MONEY,
    "PRICE": T.DecimalType(10, 2),
    "TIMESTAMP": T.TimestampType(),
    "LABELS": T.MapType(T.StringType(), T.StringType()),
    "ITEMS": T.ArrayType(
        T.StructType()
        .add("sku", T.StringType())
        .add("quantity", T.IntegerType())
        .add("unit_price", T.DoubleType())
    ),
}


def struct(fields: str) -> T.StructType:
    """Struct from ``name TYPE, ...``; unlike a DDL string it needs no session."""
    built = T.StructType()
    for field in fields.split(","):
        name, kind = field.split()
        built = built.add(name, _TYPES[kind])
    return built


# The record layouts of the message log, the CDC feed, the
# relational sources and the order events.
ENVELOPE = struct(
    "key BINARY, value BINARY, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP, timestampType INT"
)
CDC_ORDER = struct(
    "order_id INT, customer_id INT, status STRING, total_amount DOUBLE, "
    "currency STRING, created_at STRING, updated_at STRING, __deleted STRING, "
    "__op STRING, __table STRING, __source_ts_ms BIGINT, __source_lsn BIGINT"
)
CDC_SOURCE = struct(
    "version STRING, connector STRING, name STRING, ts_ms BIGINT, lsn BIGINT, txId BIGINT, "
    "table STRING"
)
ORDER_MODEL = struct(
    "order_id BIGINT, customer_id BIGINT, status STRING, total_amount MONEY, "
    "currency STRING, created_at TIMESTAMP, updated_at TIMESTAMP"
)
PLACE_ORDER = struct(
    "command_type STRING, order_id STRING, customer_id STRING, "
    "items ITEMS, currency STRING"
)
# One wide row per event; columns that an event type does not carry are null.
ORDER_EVENTS = struct(
    "event_id STRING, order_id STRING, occurred_at TIMESTAMP, version INT, "
    "event_type STRING, partition INT, offset BIGINT, customer_id STRING, "
    "items ITEMS, "
    "total DOUBLE, currency STRING, amount DOUBLE, transaction_id STRING, "
    "reason STRING, reservation_id STRING, missing_sku STRING, "
    "tracking_number STRING, carrier STRING, delivered_at TIMESTAMP"
)
RUN_LOG = struct(
    "batch_id STRING, source STRING, started STRING, finished STRING, n_read BIGINT, "
    "n_valid BIGINT, n_rejected BIGINT, n_empty_lines BIGINT, status STRING"
)
HISTORY = struct(
    "version BIGINT, committed_at TIMESTAMP, operation STRING, num_rows BIGINT"
)
# End of fixed values.
