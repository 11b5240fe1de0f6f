"""Validation of JSON lines as column expressions over ``VARIANT``."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Required fields, error codes and thresholds of the ingest contract.
REQUIRED_FIELDS = ("order_id", "customer_id", "amount", "currency", "created_at")
JSON_DECODE = "json_decode"
NOT_AN_OBJECT = "not_an_object"
MISSING_FIELD = "missing_field"
NULL_FIELD = "null_field"
MISSING_OR_NULL_FIELD = "missing_or_null_field"
AMOUNT_NOT_NUMERIC = "amount_not_numeric"
AMOUNT_NEGATIVE = "amount_negative"
INVALID_ISO_TIMESTAMP = "invalid_iso_timestamp"
SUSPICIOUS_AMOUNT = 100_000
WARN_REJECTED_RATIO = 0.10
# End of fixed values.

# Blank as Unicode sees it, with the four ASCII separators added.
_BLANK = r"(?U)^[\s\x1C-\x1F]*$"
_NUMERIC = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


@dataclass(frozen=True)
class RuleSet:
    """Which fields and checks apply to an object.

    ``merge_missing_and_null`` reports one code for an absent and for a null field.
    ``extended`` adds the sign, timestamp and suspicious-amount checks.
    """

    required: tuple[str, ...] = REQUIRED_FIELDS
    amount: str | None = "amount"
    timestamp: str = "created_at"
    merge_missing_and_null: bool = False
    extended: bool = False


def is_blank(line: Column) -> Column:
    return line.rlike(_BLANK)


def strict_variant(line: Column) -> Column:
    """The line as a variant, or null unless the whole line is one JSON text.

    The parser stops after the first value, so text after it must be caught: the
    line has to stay valid both inside an array and inside an object.
    """
    inside_array = F.try_parse_json(F.concat(F.lit("["), line, F.lit("]")))
    inside_object = F.try_parse_json(F.concat(F.lit('{"x":'), line, F.lit("}")))
    return F.when(inside_array.isNotNull(), F.try_variant_get(inside_object, "$.x", "variant"))


def is_object(line: Column) -> Column:
    """Whether a line that is one JSON text is an object: its first sign tells."""
    return line.rlike(r"^[ \t\r\n]*\{")


def _field(record: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(record, f"$.{name}", kind)


def object_errors(record: Column, rules: RuleSet) -> Column:
    """Error codes of one JSON object, in field order and then rule order."""
    checks: list[Column] = []
    for name in rules.required:
        value = _field(record, name)
        if rules.merge_missing_and_null:
            gone = value.isNull() | F.is_variant_null(value)
            checks.append(F.when(gone, f"{MISSING_OR_NULL_FIELD}:{name}"))
        else:
            checks.append(
                F.when(value.isNull(), f"{MISSING_FIELD}:{name}").when(
                    F.is_variant_null(value), f"{NULL_FIELD}:{name}"
                )
            )
    if rules.amount:
        amount = _field(record, rules.amount)
        present = amount.isNotNull() & ~F.is_variant_null(amount)
        numeric = F.schema_of_variant(amount).rlike(_NUMERIC)
        checks.append(F.when(present & ~numeric, AMOUNT_NOT_NUMERIC))
        if rules.extended:
            number = _field(record, rules.amount, "double")
            checks.append(F.when(present & numeric & (number < 0), AMOUNT_NEGATIVE))
    if rules.extended:
        stamp = _field(record, rules.timestamp)
        text = _field(record, rules.timestamp, "string")
        checks.append(
            F.when(
                stamp.isNotNull()
                & ~F.is_variant_null(stamp)
                & F.try_to_timestamp(text).isNull(),
                INVALID_ISO_TIMESTAMP,
            )
        )
    return F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")


def line_errors(line: Column, record: Column, rules: RuleSet) -> Column:
    """Error codes of a non-blank line parsed by :func:`strict_variant`."""
    return (
        F.when(record.isNull(), F.array(F.lit(JSON_DECODE)))
        .when(~is_object(line), F.array(F.lit(NOT_AN_OBJECT)))
        .otherwise(object_errors(record, rules))
    )


def route(line: Column, record: Column, errors: Column, rules: RuleSet) -> Column:
    """``blank``, ``rejected``, ``suspicious`` (extended rules only) or ``valid``."""
    chosen = F.when(is_blank(line), "blank").when(F.size(errors) > 0, "rejected")
    if rules.extended and rules.amount:
        amount = _field(record, rules.amount, "double")
        chosen = chosen.when(amount > SUSPICIOUS_AMOUNT, "suspicious")
    return chosen.otherwise("valid")


def run_status(n_read: Column, n_valid: Column, n_rejected: Column) -> Column:
    """``EMPTY``, ``WARN`` or ``OK`` for one run."""
    return (
        F.when(n_read == 0, "EMPTY")
        .when(n_valid == 0, "WARN")
        .when(n_rejected / n_read > WARN_REJECTED_RATIO, "WARN")
        .otherwise("OK")
    )
