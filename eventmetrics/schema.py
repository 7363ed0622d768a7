"""Declared schemas and the value sets that queries depend on. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DateType,
    DecimalType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Must equal the source data's, or results differ.
EVENT_TYPES = ("page_view", "search", "add_to_cart", "purchase", "logout")
REQUIRED_FIELDS = ("user_id", "event_type", "timestamp")
PURCHASE = "purchase"
WINDOW_DURATION = "5 minutes"

_TEXT_FIELDS = ("user_id", "event_type", "timestamp", "session_id", "device", "page", "country")

# One event as it travels: seven texts and an optional amount, all nullable.
EVENT_SCHEMA = StructType(
    [StructField(name, StringType()) for name in _TEXT_FIELDS]
    + [StructField("amount", DoubleType())]
)

# Amounts are summed as decimals, so that the total does not depend on the order in which
# partitions are merged, and a sum is rounded to cents once, at the end. NaN and infinity have no
# decimal; the check `amounts` counts them.
AMOUNT = DecimalType(38, 6)
MONEY_SUM = DecimalType(38, 2)

# What identifies one aggregate.
AGGREGATE_KEY = ("window_start", "window_end", "event_type", "country")
MEASURES = ("event_count", "unique_users", "total_revenue")

_KEY_FIELDS = [
    StructField("window_start", TimestampType()),
    StructField("window_end", TimestampType()),
    StructField("event_type", StringType()),
    StructField("country", StringType()),
]
_MEASURE_FIELDS = [
    StructField("event_count", LongType()),
    StructField("unique_users", LongType()),
    StructField("total_revenue", MONEY_SUM),
]
_CREATED_AT = StructField("created_at", TimestampType())

# Serving table: one row per key.
AGGREGATE_SCHEMA = StructType(_KEY_FIELDS + _MEASURE_FIELDS + [_CREATED_AT])

# As it is stored: with a sketch of the users, which can be merged over windows, and by date, which
# is the name of a directory and hence last.
USER_SKETCH = "user_sketch"
WINDOW_DATE = "window_date"
SERVING_SCHEMA = StructType(AGGREGATE_SCHEMA.fields + [
    StructField(USER_SKETCH, BinaryType()), StructField(WINDOW_DATE, DateType())])

# One row per micro-batch of a stream, written when the rest of it is. `latest_event_time` is that of
# all batches so far; `mark` is the time up to which windows were closed.
PROGRESS_SCHEMA = StructType(
    [StructField(name, LongType())
     for name in ("messages", "events", "late_events", "dropped", "faulty_events")]
    + [StructField(name, TimestampType()) for name in ("latest_event_time", "mark", "written_at")]
    + [StructField("batch_id", LongType())]
)

# Aggregate log, by date and micro-batch. A row has either one user's share of a key in that
# micro-batch (no unique_users; such rows add up), or a state after it, of which the newest counts:
# the key's, or one user's (unique_users is 1, or 0 without user_id; users add up). Revenue is not
# rounded yet.
AGGREGATE_LOG_SCHEMA = StructType(
    _KEY_FIELDS
    + [StructField("user_id", StringType())]
    + _MEASURE_FIELDS[:2]
    + [StructField("total_revenue", AMOUNT), _CREATED_AT, StructField(WINDOW_DATE, DateType()),
       StructField("batch_id", LongType())]
)
