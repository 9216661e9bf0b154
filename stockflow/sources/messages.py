"""Keyed JSON messages: reading, decoding, quarantining and publishing."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.functions.scalars import instant
from stockflow.sources.schemas import ROUTES

CORRUPT = "_corrupt"
DEAD_LETTERS = "dead_letters"
#: Strings are quoted as JSON has it.
_STRICT = {"allowSingleQuotes": "false"}


def kafka_stream(
    spark: SparkSession,
    servers: str,
    topics: Sequence[str] = tuple(ROUTES),
    max_offsets_per_trigger: int = 50_000_000,
) -> DataFrame:
    """Subscribe to the topics from the earliest offset; progress lives in the checkpoint.

    Needs the Kafka connector on the classpath. ``arrival`` columns are ``partition`` and ``offset``.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets_per_trigger)
        .load()
    )


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, max_files_per_trigger: int = 1000
) -> DataFrame:
    """The same envelope from a folder of Parquet files."""
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(path)
    )


def _parsed(wire: T.StructType) -> Column:
    schema = T.StructType([*wire.fields, T.StructField(CORRUPT, T.StringType())])
    return F.from_json(F.expr("cast(value AS string)"), schema, {"columnNameOfCorruptRecord": CORRUPT, **_STRICT})


def _fault(event: str) -> str:
    """Why a parsed message is no event; NULL for a good one.

    A value is one JSON object and nothing else. The parser stops at the end of the first, so the
    text is also read inside a list, where it must be the only element, and inside an object,
    where what follows it must still be found.
    """
    text = "cast(value AS string)"
    strict = "map({})".format(", ".join(f"'{k}', '{v}'" for k, v in _STRICT.items()))
    alone = f"size(from_json(concat('[', {text}, ']'), 'array<string>', {strict})) = 1"
    ended = f"""from_json(concat('{{"value":', {text}, ',"ended":true}}'), 'ended boolean', {strict}).ended"""
    return (
        f"CASE WHEN {event} IS NULL OR {event}.{CORRUPT} IS NOT NULL OR NOT coalesce({alone}, false) "
        f"OR NOT coalesce({ended}, false) THEN 'malformed' "
        f"WHEN {event}.event_id IS NULL THEN 'missing event_id' END"
    )


def decode(messages: DataFrame, wire: T.StructType) -> DataFrame:
    """Parse the JSON value next to the envelope columns, as ``event`` and ``reason``.

    ``reason`` is NULL for a good row; a row that does not parse, or has no event id, says why.
    """
    return messages.withColumn("event", _parsed(wire)).withColumn("reason", F.expr(_fault("event")))


def route(messages: DataFrame, position: Sequence[str]) -> DataFrame:
    """Every message with the table it goes to, its parsed event, and the id it has there.

    ``table_name`` is the raw table of the topic, in whose column the event is; what is no event,
    and what no table takes, goes to the dead letters with a ``reason``. A dead letter's id is a
    digest of its content and of ``position``, its place in the source, so reading a source again
    gives the same letters.
    """
    columns = messages.columns
    for topic, (table, wire) in ROUTES.items():
        messages = messages.withColumn(table, F.when(F.col("topic") == topic, _parsed(wire)))
    faults = " ".join(f"WHEN '{topic}' THEN {_fault(table)}" for topic, (table, _) in ROUTES.items())
    targets = " ".join(f"WHEN '{topic}' THEN '{table}'" for topic, (table, _) in ROUTES.items())
    ids = ", ".join(f"{table}.event_id" for table, _ in ROUTES.values())
    parts = ["topic", "hex(key)", "hex(value)", *[f"string({c})" for c in position]]
    letter = f"sha2(to_json(array({', '.join(parts)})), 256)"
    return messages.withColumn(
        "reason", F.expr(f"CASE topic {faults} ELSE 'no handler for topic' END")
    ).selectExpr(
        *columns,
        *[table for table, _ in ROUTES.values()],
        "reason",
        f"CASE WHEN reason IS NULL THEN CASE topic {targets} END ELSE '{DEAD_LETTERS}' END AS table_name",
        f"CASE WHEN reason IS NULL THEN coalesce({ids}) ELSE {letter} END AS row_id",
    )


def events(decoded: DataFrame, wire: T.StructType, keep: Sequence[str], event: str = "event") -> DataFrame:
    """Good rows as table columns (``timestamp`` becomes ``ts``), plus the ``keep`` columns."""
    fields = [f"{event}.{f.name} AS {'ts' if f.name == 'timestamp' else f.name}" for f in wire]
    return decoded.filter("reason IS NULL").selectExpr(*fields, *keep)


def rejected(messages: DataFrame, at: dt.datetime) -> DataFrame:
    """Rows of ``route`` with a ``reason``, in the shape of the dead-letter table."""
    return messages.filter("reason IS NOT NULL").selectExpr(
        "row_id AS letter_id",
        "topic",
        "cast(key AS string) AS key",
        "cast(value AS string) AS value",
        "cast(value AS binary) AS raw_value",
        "reason",
        f"{instant(at)} AS ingested_at",
    )


def to_messages(df: DataFrame, topic: str, key: str = "sku") -> DataFrame:
    """Rows as (topic, key, value) with a JSON value, ready for a Kafka or file sink."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("binary").alias("key"),
        F.to_json(F.struct(*df.columns)).cast("binary").alias("value"),
    )


def publish(messages: DataFrame, servers: str) -> None:
    """Send keyed messages to their topics, acknowledged by all replicas."""
    (
        messages.write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.compression.type", "gzip")
        .save()
    )
