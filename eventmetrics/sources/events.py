"""Event sources, the message codec, and the topic sink.

Kafka needs Spark's Kafka connector on the class path (`spark.jars.packages`); text, JSON
and Parquet work out of the box.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from eventmetrics.schema import EVENT_SCHEMA, PROGRESS_SCHEMA

# The topic and servers that producers use.
TOPIC = "user-events"
BOOTSTRAP_SERVERS = "localhost:9092"

# Messages with a fault, and whether it kept them out of the lake.
FAULT_SCHEMA = StructType([StructField("value", StringType()), StructField("fault", StringType()),
                           StructField("dropped", BooleanType())])

MESSAGE_SCHEMA = StructType([StructField("value", StringType())])

# Enriched events at rest; the two partition columns come last when read back.
LAKE_SCHEMA = StructType(
    [f for f in EVENT_SCHEMA.fields if f.name != "event_type"]
    + [
        StructField("event_time", TimestampType()),
        StructField("event_hour", IntegerType()),
        StructField("is_purchase", BooleanType()),
        StructField("event_date", DateType()),
        StructField("event_type", StringType()),
    ]
)
LATE_SCHEMA = StructType([*LAKE_SCHEMA.fields, StructField("batch_id", LongType())])

_CORRUPT = "_corrupt_record"
_FILE_SCHEMAS = {"text": MESSAGE_SCHEMA, "json": EVENT_SCHEMA, "parquet": EVENT_SCHEMA}


def kafka_options(starting_offsets: str | None = None) -> dict[str, str]:
    """Connection to the event topic; the servers come from KAFKA_BOOTSTRAP_SERVERS."""
    options = {
        "kafka.bootstrap.servers": os.environ.get("KAFKA_BOOTSTRAP_SERVERS", BOOTSTRAP_SERVERS),
    }
    if starting_offsets:
        options |= {"subscribe": TOPIC, "startingOffsets": starting_offsets}
    return options


def read_event_stream(spark: SparkSession, fmt: str = "kafka",
                      options: Mapping[str, str] | None = None) -> DataFrame:
    """An unbounded source of messages (kafka, text) or events (json, parquet).

    Kafka starts at the latest offsets of the topic. With few topic partitions, the Kafka
    option `minPartitions` splits them over more tasks; `maxOffsetsPerTrigger`, or
    `maxFilesPerTrigger` for files, bounds a micro-batch. Files need the option `path`.
    """
    return _load(spark.readStream, fmt, "latest", options)


def read_events(spark: SparkSession, fmt: str = "kafka",
                options: Mapping[str, str] | None = None) -> DataFrame:
    """The same sources as a bounded read; Kafka starts at the earliest offsets."""
    return _load(spark.read, fmt, "earliest", options)


def _load(reader, fmt: str, starting_offsets: str, options: Mapping[str, str] | None) -> DataFrame:
    defaults = kafka_options(starting_offsets) if fmt == "kafka" else {}
    reader = reader.format(fmt).options(**{**defaults, **(options or {})})
    if fmt in _FILE_SCHEMAS:
        reader = reader.schema(_FILE_SCHEMAS[fmt])
    return reader.load()


def decode_events(df: DataFrame) -> DataFrame:
    """JSON in `value` (bytes or text) to event columns.

    Malformed or NULL text gives a row of NULLs, a mistyped field a NULL; unknown keys are
    ignored.

    `inline` makes the parsed fields the output of a generator. A plain projection would be
    inlined into the filters on its fields, and every message parsed once per such field.
    """
    event = F.from_json(F.col("value").cast("string"), EVENT_SCHEMA)
    return df.select(F.inline(F.array(event)))


def decode_messages(df: DataFrame) -> DataFrame:
    """`value` as text, its event columns, and `corrupt`: whether it is no event as declared.

    The event columns are those of `decode_events`. A message that cannot be parsed at all has none
    of them; one with a mistyped field has the others.
    """
    value = F.col("value").cast("string")
    schema = StructType([*EVENT_SCHEMA.fields, StructField(_CORRUPT, StringType())])
    event = F.from_json(value, schema, {"columnNameOfCorruptRecord": _CORRUPT})
    return df.select(value.alias("value"), F.inline(F.array(event))).withColumn(
        "corrupt", F.col(_CORRUPT).isNotNull()).drop(_CORRUPT)


def encode_events(df: DataFrame) -> DataFrame:
    """Event columns to one JSON text per event in `value`; NULLs are written out."""
    fields = F.struct(*EVENT_SCHEMA.fieldNames())
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def write_events(df: DataFrame, fmt: str = "kafka", options: Mapping[str, str] | None = None,
                 mode: str = "append") -> None:
    """Encode events and send them to the topic, or to text files at the option `path`."""
    defaults = {**kafka_options(), "topic": TOPIC} if fmt == "kafka" else {}
    (encode_events(df).write.format(fmt).mode(mode)
        .options(**{**defaults, **(options or {})}).save())


def peek_events(df: DataFrame, n: int = 5,
                order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """The first n events, decoded if they are messages.

    As they come, tasks stop reading as soon as n have been found. With `order_by`, such as
    partition and offset, it is one top-k over all of them: each task keeps n rows.
    """
    if order_by:
        df = df.orderBy(*order_by).limit(n)
    events = decode_events(df) if "value" in df.columns else df
    return events if order_by else events.limit(n)


def read_event_lake(spark: SparkSession, path: str) -> DataFrame:
    """Enriched events at rest, pruned by filters on event_date and event_type."""
    # A stream's micro-batches have folders of their own below those, which are no concern here.
    return spark.read.schema(LAKE_SCHEMA).parquet(path).select(LAKE_SCHEMA.fieldNames())


def read_late_events(spark: SparkSession, path: str) -> DataFrame:
    """The events that came after their window was closed, and the micro-batch that they came in."""
    return spark.read.schema(LATE_SCHEMA).parquet(path)


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """What each micro-batch of a stream did: see PROGRESS_SCHEMA."""
    return spark.read.schema(PROGRESS_SCHEMA).parquet(path)


def read_faults(spark: SparkSession, path: str) -> DataFrame:
    """The messages that a stream found fault with: value, fault, dropped."""
    return spark.read.schema(FAULT_SCHEMA).parquet(path).select(FAULT_SCHEMA.fieldNames())
