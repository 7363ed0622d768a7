"""Row-level operators on events. All are narrow: they filter or project, never shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmetrics.schema import EVENT_SCHEMA, EVENT_TYPES, PURCHASE, REQUIRED_FIELDS

#: Faults of events that stay.
KEPT_FAULTS = ("mistyped field", "no time")


def clean_events(df: DataFrame, allowed: Iterable[str] = EVENT_TYPES) -> DataFrame:
    """Keep events that have every required field and an allowed type (case-sensitive).

    Empty texts count as present. Undecodable messages have only NULLs and go here too.
    """
    return df.dropna(subset=list(REQUIRED_FIELDS)).filter(F.col("event_type").isin(*allowed))


def with_fault(messages: DataFrame, allowed: Iterable[str] = EVENT_TYPES) -> DataFrame:
    """Decoded messages with `fault`: why `clean_events` drops them, or what they lack; else NULL.

    In this order: `no message`, `malformed`, `missing field`, `unknown type`, and for events that
    stay `mistyped field` and `no time` (a text that is not a time: the event is in no window).
    """
    fields = [F.col(name) for name in EVENT_SCHEMA.fieldNames()]
    missing = F.lit(False)
    for name in REQUIRED_FIELDS:
        missing = missing | F.col(name).isNull()
    return messages.withColumn("fault", F.when(F.col("value").isNull(), "no message")
                               .when(F.col("corrupt") & F.coalesce(*[f.cast("string") for f in fields]).isNull(),
                                     "malformed")
                               .when(missing, "missing field")
                               .when(~F.col("event_type").isin(*allowed), "unknown type")
                               .when(F.col("corrupt"), "mistyped field")
                               .when(F.try_to_timestamp(F.col("timestamp")).isNull(), "no time"))


def faulty_messages(judged: DataFrame) -> DataFrame:
    """value, fault and dropped of the messages that have a fault."""
    return judged.filter("fault IS NOT NULL").select(
        "value", "fault", (~F.col("fault").isin(*KEPT_FAULTS)).alias("dropped"))


def with_event_time(df: DataFrame) -> DataFrame:
    """Add `event_time`, the parsed `timestamp`; NULL when the text is not a time."""
    return df.withColumn("event_time", F.try_to_timestamp(F.col("timestamp")))


def enrich_events(df: DataFrame) -> DataFrame:
    """Add event_time, event_date, event_hour and is_purchase."""
    return with_event_time(df).withColumns({
        "event_date": F.to_date("event_time"),
        "event_hour": F.hour("event_time"),
        "is_purchase": F.col("event_type") == F.lit(PURCHASE),
    })


def purchase_events(enriched: DataFrame) -> DataFrame:
    """The enriched events that are purchases."""
    return enriched.filter("is_purchase")
