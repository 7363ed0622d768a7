"""Codec, peek, file sources, and the options of sources that are not available here."""

import json

import pytest
from pyspark.sql.types import StructType

from eventmetrics import (
    EVENT_SCHEMA,
    clean_events,
    decode_events,
    encode_events,
    peek_events,
    read_aggregates,
    read_events,
    write_events,
)
from eventmetrics.sources import events as source
from eventmetrics.sources.aggregates import COLUMN_TYPES, jdbc_options
from tests.conftest import rows_of

MESSAGES = [
    ("garbage",), (None,), ("",), ("null",), ('{"user_id":"b"',),
    ('{"user_id":"a","event_type":"search","timestamp":"2026-01-15T10:00:00","amount":"x",'
     '"extra":1}',),
]


def test_bad_messages_become_null_rows_that_cleaning_drops(spark):
    decoded = decode_events(spark.createDataFrame(MESSAGES, "value string"))
    assert decoded.columns == EVENT_SCHEMA.fieldNames()
    assert decoded.count() == len(MESSAGES)
    kept = clean_events(decoded).collect()
    assert [(r["user_id"], r["amount"]) for r in kept] == [("a", None)]


def test_bytes_are_decoded(spark):
    df = spark.createDataFrame([(bytearray(b'{"user_id":"\xc3\xa9"}'),)], "value binary")
    assert decode_events(df).first()["user_id"] == "é"


def test_encoding_writes_nulls_and_round_trips(four_rows):
    encoded = encode_events(four_rows)
    first = json.loads(encoded.first()["value"])
    assert first["amount"] is None
    assert list(first) == EVENT_SCHEMA.fieldNames()
    assert rows_of(decode_events(encoded)) == rows_of(four_rows)


def test_each_message_is_parsed_once(std):
    plan = clean_events(decode_events(encode_events(std)))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def test_text_files_round_trip(spark, std, tmp_path):
    path = str(tmp_path / "topic")
    write_events(std, "text", {"path": path})
    assert rows_of(decode_events(read_events(spark, "text", {"path": path}))) == rows_of(std)


def test_json_files_are_read_with_the_declared_schema(spark, four_rows, tmp_path):
    path = str(tmp_path / "json")
    four_rows.write.json(path)
    read = read_events(spark, "json", {"path": path})
    assert read.schema == EVENT_SCHEMA
    assert rows_of(read) == rows_of(four_rows)


def test_peek_takes_the_first_messages_in_order(spark):
    messages = spark.createDataFrame(
        [(json.dumps({"user_id": f"u{i}"}), 0, i) for i in range(20)],
        "value string, partition int, offset long").repartition(4)
    first = peek_events(messages, order_by=["partition", "offset"])
    assert [r["user_id"] for r in first.collect()] == [f"u{i}" for i in range(5)]


def test_peek_stops_reading_once_it_has_enough(spark):
    messages = spark.range(0, 1000, 1, 100).selectExpr(
        "to_json(named_struct('user_id', string(id))) AS value")
    first = peek_events(messages)
    assert [r["user_id"] for r in first.collect()] == ["0", "1", "2", "3", "4"]
    assert "CollectLimit 5" in first._jdf.queryExecution().executedPlan().toString()


def test_peek_at_a_table_is_a_top_k(spark, std):
    first = peek_events(std, 3, ["timestamp", "session_id"])
    assert first.count() == 3
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_kafka_options(monkeypatch):
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:1")
    assert source.kafka_options("latest") == {
        "kafka.bootstrap.servers": "broker:1", "subscribe": "user-events",
        "startingOffsets": "latest"}
    assert "subscribe" not in source.kafka_options()


def test_kafka_without_its_connector_says_so(spark):
    with pytest.raises(Exception, match="kafka"):
        read_events(spark)


def test_jdbc_options_fill_in_the_table():
    given = {"url": "jdbc:postgresql://host/pipeline", "user": "me"}
    options = jdbc_options(given)
    assert options["dbtable"] == "event_aggregates"
    assert options["user"] == "me"
    assert "dbtable" not in jdbc_options({**given, "query": "SELECT 1"})
    assert jdbc_options({**given, "batchsize": "5"})["batchsize"] == "5"
    with pytest.raises(ValueError, match="url"):
        jdbc_options({"dbtable": "t"})


def test_a_database_read_is_split_by_time_if_its_bounds_are_given():
    bounds = {"url": "jdbc:x:y", "lowerBound": "2024-01-01", "upperBound": "2024-02-01"}
    assert "partitionColumn" not in jdbc_options(bounds)
    assert jdbc_options({**bounds, "numPartitions": "9"})["partitionColumn"] == "window_start"
    own = {**bounds, "numPartitions": "9", "partitionColumn": "event_count"}
    assert jdbc_options(own)["partitionColumn"] == "event_count"


def test_predicates_need_a_table(spark):
    with pytest.raises(ValueError, match="query"):
        read_aggregates(spark, {"url": "jdbc:x:y", "query": "SELECT 1"}, ["1 = 1"])


def test_column_sizes_are_a_valid_declaration(spark):
    assert StructType.fromDDL(COLUMN_TYPES).fieldNames() == [
        "event_type", "country", "event_count", "unique_users", "total_revenue"]
