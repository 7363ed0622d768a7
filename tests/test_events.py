"""Schema, cleaning, time parsing and enrichment."""

from datetime import date

from pyspark.sql.types import StructType

from eventmetrics import (
    AGGREGATE_SCHEMA,
    EVENT_SCHEMA,
    EVENT_TYPES,
    clean_events,
    enrich_events,
    prepare_events,
    purchase_events,
    with_event_time,
)


def test_event_schema_has_eight_nullable_fields():
    assert isinstance(EVENT_SCHEMA, StructType)
    assert EVENT_SCHEMA.fieldNames() == [
        "user_id", "event_type", "timestamp", "session_id", "device", "page", "country", "amount"]
    assert all(f.nullable for f in EVENT_SCHEMA.fields)
    assert EVENT_SCHEMA["amount"].dataType.simpleString() == "double"


def test_aggregate_schema_counts_in_64_bits():
    types = {f.name: f.dataType.simpleString() for f in AGGREGATE_SCHEMA.fields}
    assert types["event_count"] == types["unique_users"] == "bigint"
    assert types["window_start"] == types["created_at"] == "timestamp"


def test_cleaning_drops_null_users_and_unknown_types(four_rows):
    kept = clean_events(four_rows).collect()
    assert len(kept) == 2
    assert {row["event_type"] for row in kept} <= set(EVENT_TYPES)


def test_each_required_field_is_required(events):
    df = events({"user_id": None}, {"event_type": None}, {"timestamp": None},
                {"country": None, "page": None, "session_id": None, "device": None})
    assert clean_events(df).count() == 1


def test_empty_texts_stay_and_case_matters(events):
    df = events({"user_id": ""}, {"event_type": "Purchase"}, {"event_type": ""})
    assert [row["user_id"] for row in clean_events(df).collect()] == [""]


def test_allow_list_can_be_changed(four_rows):
    assert clean_events(four_rows, ["unknown"]).count() == 1


def test_enriched_columns(four_rows):
    rows = {r["user_id"]: r for r in enrich_events(clean_events(four_rows)).collect()}
    assert rows["u2"]["event_date"] == date(2026, 1, 15)
    assert rows["u2"]["event_hour"] == 11
    assert rows["u2"]["is_purchase"] is True
    assert rows["u1"]["is_purchase"] is False
    assert rows["u1"]["timestamp"] == "2026-01-15T10:00:00"


def test_one_purchase(four_rows):
    assert purchase_events(enrich_events(clean_events(four_rows))).count() == 1


def test_unparsable_time_stays_with_null_date(events):
    row = prepare_events(events({"timestamp": "garbage"})).first()
    assert row["timestamp"] == "garbage"
    assert row["event_time"] is None
    assert row["event_date"] is None
    assert row["event_hour"] is None


def test_time_formats(events, spark):
    df = with_event_time(events(
        {"timestamp": "2026-01-15T10:00:00.250"}, {"timestamp": "2026-01-15 10:00:00"},
        {"timestamp": "2026-01-15T12:00:00+02:00"}))
    shown = df.selectExpr("date_format(event_time, 'HH:mm:ss') AS t").collect()
    assert [row["t"] for row in shown] == ["10:00:00"] * 3
