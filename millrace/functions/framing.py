"""Schema-registry framing of message values: one zero byte, a four-byte
big-endian schema id, then the payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the wire format.
MAGIC = b"\x00"
HEADER_BYTES = 5


def frame_error(value: Column) -> Column:
    """Null for a well-formed frame, otherwise why the value is not one.

    A frame needs at least one payload byte: a bare header decodes to nothing.
    """
    size = F.octet_length(value)
    return (
        F.when(value.isNull(), "tombstone")
        .when(size < HEADER_BYTES, "short_frame")
        .when(F.substring(value, 1, 1) != F.lit(MAGIC), "bad_magic")
        .when(size == HEADER_BYTES, "empty_payload")
    )


def is_framed(value: Column) -> Column:
    return frame_error(value).isNull()


def schema_id(value: Column) -> Column:
    return F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("int")


def payload(value: Column) -> Column:
    return F.substring(value, HEADER_BYTES + 1, 2_147_483_647)


def add_frame(payload_text: Column, schema: int) -> Column:
    """The inverse of :func:`payload`, for producers of framed values."""
    header = F.lit(MAGIC + schema.to_bytes(4, "big"))
    return F.concat(header, F.encode(payload_text, "UTF-8"))
