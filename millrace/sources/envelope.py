"""Message-log sources. A message is a row of the seven-column envelope, whether
it comes from a broker or from files of the same layout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import framing
from millrace.functions.rules import strict_variant
from millrace.schemas import ENVELOPE

UNDECODABLE = "undecodable"
UNKNOWN_SCHEMA = "unknown_schema"
FILES_PER_TRIGGER = 1_000
_CORRUPT = "_corrupt"


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topic: str | None = None,
    pattern: str | None = None,
    starting_offsets: str = "earliest",
) -> DataFrame:
    """Stream of one topic, or of every topic whose name matches ``pattern``.

    Needs the Kafka connector on the classpath.
    """
    if (topic is None) == (pattern is None):
        raise ValueError("give either a topic or a pattern")
    choice = ("subscribe", topic) if topic else ("subscribePattern", pattern)
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option(*choice)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
        .load()
    )


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType = ENVELOPE,
    max_files_per_trigger: int = FILES_PER_TRIGGER,
) -> DataFrame:
    """Stream over Parquet files of the given layout; ``path`` is a folder or a file.

    A micro-batch takes a bounded number of files, so that a backlog is worked off in
    steps and the watermark moves on between them. The braces make a glob of the path,
    which a stream accepts for a single file too.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    folder, _, name = path.rstrip("/").rpartition("/")
    return reader.parquet(f"{folder}/{{{name}}}")


def as_text(envelope: DataFrame) -> DataFrame:
    """Key and value as text; the record timestamp is called ``kafka_ts``."""
    return envelope.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ts"),
    )


def topics_matching(envelope: DataFrame, pattern: str) -> DataFrame:
    """Messages of every topic whose whole name matches the pattern."""
    return envelope.filter(F.col("topic").rlike(f"^(?:{pattern})$"))


def json_payload(schema: T.StructType):
    """Decoder of framed UTF-8 JSON: null unless the whole payload is one JSON text and
    every field that is present has the type of the schema."""
    marked = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}

    def decoder(payload: Column) -> Column:
        text = payload.cast("string")
        parsed = F.from_json(text, marked, options)
        whole = F.is_valid_utf8(text) & strict_variant(text).isNotNull()
        fields = F.struct(*[parsed[f.name].alias(f.name) for f in schema.fields])
        return F.when(whole & parsed.isNotNull() & parsed[_CORRUPT].isNull(), fields)

    return decoder


def avro_payload(avro_schema: str):
    """Decoder of framed Avro; needs the Avro module on the classpath."""
    from pyspark.sql.avro.functions import from_avro

    return lambda payload: from_avro(payload, avro_schema, {"mode": "PERMISSIVE"})


def decode(envelope: DataFrame, decoder, required: list[str]) -> DataFrame:
    """Envelope with ``data`` decoded and ``error_class, error_message`` where it failed.

    A payload counts as undecodable when it comes out null or any required field does.
    """
    broken = framing.frame_error(F.col("value"))
    return _decoded(envelope, broken, decoder(framing.payload(F.col("value"))), required)


def decode_by_id(
    envelope: DataFrame,
    decoders: dict[int, tuple[T.StructType, Callable]],
    reader: T.StructType,
    required: list[str],
) -> DataFrame:
    """Like :func:`decode`, each message by the decoder of the schema id in its frame.

    ``decoders``: the schema of each id and its decoder; ``reader`` is the schema that all come out in: fields that a message's own schema lacks
    are null, those that only it has are left out. An id without decoder is an error of its own.
    """
    number = framing.schema_id(F.col("value"))
    payload = framing.payload(F.col("value"))
    broken = F.coalesce(
        framing.frame_error(F.col("value")),
        F.when(~number.isin(*decoders), UNKNOWN_SCHEMA),
    )
    data = None
    for schema, (writer, decoder) in decoders.items():
        made = _as_read(decoder(payload), writer, reader)
        data = F.when(number == schema, made) if data is None else data.when(number == schema, made)
    return _decoded(envelope, broken, data, required)


def _as_read(data: Column, writer: T.StructType, reader: T.StructType) -> Column:
    """A decoded struct with the fields of the reader's schema, by name."""
    fields = [
        (data[f.name] if f.name in writer.names else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in reader
    ]
    return F.when(data.isNotNull(), F.struct(*fields))


def _decoded(envelope: DataFrame, broken: Column, data: Column, required: list[str]) -> DataFrame:
    data = F.when(broken.isNull(), data)
    decoded = envelope.withColumn("data", data)
    undecodable = F.col("data").isNull()
    for name in required:
        undecodable = undecodable | F.col(f"data.{name}").isNull()
    error = F.coalesce(broken, F.when(undecodable, UNDECODABLE))
    return decoded.select(
        F.col("key").cast("string").alias("kafka_key"),
        "data",
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_ts"),
        "value",
        error.alias("error_class"),
        _error_message(error).alias("error_message"),
    )


def _error_message(error: Column) -> Column:
    return F.when(
        error.isNotNull(),
        F.concat_ws(
            " ",
            error,
            F.lit("at"),
            F.concat_ws(":", F.col("topic"), F.col("partition"), F.col("offset")),
        ),
    )


def good_messages(decoded: DataFrame, strict: bool = False) -> DataFrame:
    """Rows that decoded. In strict mode the first broken one fails the job."""
    if strict:
        checked = F.when(
            F.col("error_class").isNotNull(), F.raise_error(F.col("error_message"))
        ).otherwise(F.lit(True))
        decoded = decoded.filter(checked)
    else:
        decoded = decoded.filter(F.col("error_class").isNull())
    return decoded.drop("value", "error_class", "error_message")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Rows that did not decode, with where they came from and why they failed."""
    return decoded.filter(F.col("error_class").isNotNull()).select(
        "kafka_key",
        "value",
        "topic",
        "partition",
        "offset",
        "kafka_ts",
        "error_class",
        "error_message",
    )
