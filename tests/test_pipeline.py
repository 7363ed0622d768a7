"""Sinks, jobs and streams: a stream's result equals the batch result, also after failures."""

import json
import os
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import eventmetrics as em
from eventmetrics import metrics
from eventmetrics.__main__ import main
from eventmetrics.session import scratch_dir
from eventmetrics.sources import snapshots
from eventmetrics.sources.snapshots import read_snapshot
from eventmetrics.streaming import replace_dates, sinks
from eventmetrics.streaming.sinks import AVAILABLE_NOW, database_rows
from tests.conftest import rows_of

LONG = "7 days"  # so that most groups get events from every slice
KEY = ["window_start", "window_end", "event_type", "country"]


def plain(df):
    return rows_of(df.drop("created_at", "window_date", "user_sketch"))


@pytest.fixture(scope="module")
def slices(spark, std, tmp_path_factory):
    """The events as message files: slices 0 to 3 mix all times, 4 to 7 follow time."""
    root = tmp_path_factory.mktemp("slices")
    lines = [r["value"] for r in em.encode_events(std.orderBy("timestamp")).collect()]
    parts = [lines[i::4] for i in range(4)] + [lines[i * 250:(i + 1) * 250] for i in range(4)]
    for i, part in enumerate(parts):
        (root / f"part-{i}.txt").write_text("\n".join(part))
    return sorted(root.iterdir())


@pytest.fixture()
def topic(slices, tmp_path):
    """A folder that stands for the topic, and a way to send slices or texts to it."""
    folder = tmp_path / "topic"
    folder.mkdir()

    def send(*messages):
        for message in messages:
            n = len(list(folder.iterdir()))
            text = slices[message].read_text() if isinstance(message, int) else message
            file = folder / f"{n:03d}.txt"
            file.write_text(text)
            os.utime(file, (1_700_000_000 + n,) * 2)  # files are read in order of this time

    return folder, send


def stream_of(spark, folder):
    return em.read_event_stream(spark, "text", {"path": str(folder), "maxFilesPerTrigger": "1"})


def run(spark, folder, out, distinct="users", log="aggregate_log", **how):
    """Only the aggregates of the pipeline, which most tests here are about."""
    aggregates = em.window_aggregations(
        em.prepare_events(stream_of(spark, folder)), LONG, distinct, **how)
    em.write_aggregate_log(
        aggregates, f"{out}/{log}", f"{out}/checkpoints/aggregate_log", AVAILABLE_NOW,
        "append" if distinct == "two_level" else "update").awaitTermination()


def run_both(spark, folder, out, **how):
    return em.run_stream(spark, stream_of(spark, folder), str(out), LONG,
                         trigger=AVAILABLE_NOW, **how)


def log_of(spark, out):
    return em.read_aggregate_log(spark, f"{out}/aggregate_log")


@pytest.fixture(scope="module")
def expected(spark, std):
    return plain(em.window_aggregations(em.clean_events(std), LONG))


# --- Batch -------------------------------------------------------------------------------


def test_batch_job_writes_lake_and_serving_table(spark, std, tmp_path, expected):
    table = em.run_batch(spark, em.encode_events(std), str(tmp_path), LONG)
    assert plain(table) == expected
    lake = em.read_event_lake(spark, f"{tmp_path}/events")
    assert lake.columns[-2:] == ["event_date", "event_type"]
    assert rows_of(lake) == rows_of(em.prepare_events(std))


def test_batch_job_can_run_again(spark, std, tmp_path, expected):
    for _ in range(2):
        table = em.run_batch(spark, std, str(tmp_path), LONG)
    assert plain(table) == expected


def test_batch_job_without_valid_events(spark, tmp_path):
    source = spark.createDataFrame([("garbage",)], "value string")
    assert em.run_batch(spark, source, str(tmp_path)).count() == 0


def test_lake_is_pruned_by_date_and_type(spark, std, tmp_path):
    em.write_event_lake(em.prepare_events(std), str(tmp_path / "lake"))
    lake = em.read_event_lake(spark, str(tmp_path / "lake"))
    some = lake.filter("event_date = '2024-01-05' AND event_type = 'purchase'").select("amount")
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert "event_date" in filters and "event_type" in filters
    assert plan.split("ReadSchema:")[1].split("\n")[0].strip() == "struct<amount:double>"


def test_lake_keeps_events_without_a_time(spark, events, tmp_path):
    em.write_event_lake(em.prepare_events(events({"timestamp": "garbage"}, {})), str(tmp_path))
    dates = {r["event_date"] for r in em.read_event_lake(spark, str(tmp_path)).collect()}
    assert None in dates and len(dates) == 2


def test_a_hot_folder_is_written_by_several_tasks(spark, std, tmp_path):
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = {k: spark.conf.get(k) for k in (size, smallest)}
    spark.conf.set(size, "8k")
    spark.conf.set(smallest, "1k")
    try:
        hot = std.repartition(8).withColumns({
            "event_type": F.lit("search"), "timestamp": F.lit("2024-01-05T00:00:00")})
        em.write_event_lake(em.prepare_events(hot), str(tmp_path))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len(list(tmp_path.glob("*/*/*.parquet"))) > 1


def test_serving_table_is_replaced_and_pushes_filters_down(spark, std, tmp_path):
    path = str(tmp_path / "table")
    aggregates = em.window_aggregations(em.clean_events(std))
    em.replace_aggregates(aggregates.limit(3), path)
    table = em.replace_aggregates(aggregates, path)
    assert table.schema == em.SERVING_SCHEMA
    assert plain(table) == plain(aggregates)
    assert table.filter("created_at IS NULL").count() == 0
    kpis = metrics.kpi_summary(table, "Last 24 Hours", country="US", as_of="2024-01-31")
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters:")[1].split("]")[0]
    assert "EqualTo(country,US)" in pushed
    assert "GreaterThanOrEqual(window_start,2024-01-30" in pushed
    folders = plan.split("PartitionFilters:")[1].split("]")[0]
    assert "window_date" in folders and ">= 2024-01-30" in folders


def test_database_rows_hold_utc_without_a_zone(spark, std):
    rows = database_rows(em.window_aggregations(std))
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    assert types["window_start"] == types["window_end"] == "timestamp_ntz"
    assert types["total_revenue"] == "decimal(38,2)"


def test_a_database_without_its_driver_says_so(spark, std):
    target = {"url": "jdbc:postgresql://localhost/none", "driver": "org.postgresql.Driver"}
    aggregates = em.window_aggregations(std)
    for write in (lambda: em.replace_aggregates(aggregates, target),
                  lambda: em.write_aggregates_jdbc(aggregates, target["url"], props=target),
                  lambda: em.read_aggregates(spark, target)):
        with pytest.raises(Exception, match="org.postgresql.Driver"):
            write()


# --- Streams -----------------------------------------------------------------------------


def test_both_outputs_of_a_stream_equal_batch(spark, topic, tmp_path, expected, std):
    folder, send = topic
    send(0, 1, 2, 3)
    run_both(spark, folder, tmp_path)
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected
    assert plain(em.refresh_aggregates(spark, str(tmp_path))) == expected
    assert plain(em.read_aggregates(spark, f"{tmp_path}/aggregates")) == expected
    assert rows_of(em.read_event_lake(spark, f"{tmp_path}/events")) == rows_of(
        em.prepare_events(std))


def test_states_of_one_key_are_not_added_up(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1, 2, 3)
    run(spark, folder, tmp_path, distinct="approx")
    log, latest = log_of(spark, tmp_path), em.latest_aggregates(log_of(spark, tmp_path))
    assert log.select("batch_id").distinct().count() == 4
    # Sketched users differ, the rest does not.
    without = [c for c in latest.columns if c not in ("unique_users", "created_at", "window_date")]
    order = sorted([*without, "unique_users"]).index("unique_users")
    assert rows_of(latest.select(without)) == sorted(
        row[:order] + row[order + 1:] for row in expected)
    once = latest.agg(F.sum("event_count")).first()[0]
    assert log.agg(F.sum("event_count")).first()[0] > once


def test_the_stream_keeps_no_state(spark, topic, tmp_path):
    folder, send = topic
    send(0, 1)
    run(spark, folder, tmp_path)
    assert not list((tmp_path / "checkpoints").glob("**/state/*/*"))


def test_events_in_any_order_of_time_are_counted(spark, topic, tmp_path, expected):
    folder, send = topic
    send(7, 5, 4, 6)
    run(spark, folder, tmp_path)
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected


def test_stream_goes_on_after_a_restart(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1)
    run(spark, folder, tmp_path)
    half = em.latest_aggregates(log_of(spark, tmp_path)).agg(F.sum("event_count")).first()[0]
    send(2, 3)
    run(spark, folder, tmp_path)
    whole = em.latest_aggregates(log_of(spark, tmp_path))
    assert plain(whole) == expected
    assert 0 < half < whole.agg(F.sum("event_count")).first()[0]


def test_a_repeated_batch_replaces_itself(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1, 2, 3)
    run(spark, folder, tmp_path)
    before = rows_of(log_of(spark, tmp_path).drop("created_at"))
    commits = tmp_path / "checkpoints" / "aggregate_log" / "commits"
    last = max((f for f in commits.iterdir() if f.name.isdigit()), key=lambda f: int(f.name))
    for file in (last, commits / f".{last.name}.crc"):
        file.unlink(missing_ok=True)  # as if the driver died just before noting success
    run(spark, folder, tmp_path)
    assert rows_of(log_of(spark, tmp_path).drop("created_at")) == before
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected


def test_an_empty_batch_writes_nothing(spark, topic, tmp_path):
    folder, send = topic
    send("garbage")
    run(spark, folder, tmp_path)
    assert log_of(spark, tmp_path).count() == 0
    written = [p.name for p in (tmp_path / "aggregate_log").glob("*/*") if p.is_dir()]
    assert written == ["batch_id=-1"]
    send(0)
    run(spark, folder, tmp_path)
    assert log_of(spark, tmp_path).count() > 0


def test_compaction_keeps_the_state_and_the_stream_goes_on(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1, 2)
    run(spark, folder, tmp_path)
    old = log_of(spark, tmp_path)
    em.compact_aggregate_log(old, f"{tmp_path}/compacted")
    compacted = em.read_aggregate_log(spark, f"{tmp_path}/compacted")
    assert compacted.count() < old.count()
    assert plain(em.latest_aggregates(compacted)) == plain(em.latest_aggregates(old))
    # A date's merged rows are under the newest batch that they came from.
    last = old.agg(F.max("batch_id")).first()[0]
    older = old.filter(F.col("batch_id") < last).groupBy("window_date").agg(F.max("batch_id"))
    assert rows_of(compacted.filter(F.col("batch_id") < last).select(
        "window_date", "batch_id").distinct().toDF("window_date", "max(batch_id)")) == rows_of(older)

    send(3)
    run(spark, folder, tmp_path, log="compacted")
    assert plain(em.latest_aggregates(
        em.read_aggregate_log(spark, f"{tmp_path}/compacted"))) == expected


def test_a_refresh_after_compaction_takes_what_it_has_not(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1)
    run(spark, folder, tmp_path)
    em.refresh_aggregates(spark, str(tmp_path))
    send(2, 3)
    run(spark, folder, tmp_path)
    em.compact_aggregate_log(log_of(spark, tmp_path), f"{tmp_path}/compacted")
    for _ in range(2):
        table = em.refresh_aggregates(spark, str(tmp_path), log_path=f"{tmp_path}/compacted")
        assert plain(table) == expected
    versions = list((tmp_path / "aggregates" / "_manifests").glob("*.json"))
    assert len(versions) == 2  # the second refresh had nothing to take


def test_a_reader_keeps_its_snapshot_until_it_expires(spark, std, tmp_path):
    path = str(tmp_path / "table")
    all_rows = em.window_aggregations(em.clean_events(std), LONG)
    first = em.replace_aggregates(all_rows, path)
    before = plain(first)
    replace_dates(all_rows.filter("country = 'US'").limit(1), path)
    second = em.read_aggregates(spark, path)
    assert plain(first) == before and 0 < second.count() < first.count()
    assert plain(read_snapshot(spark, path, em.SERVING_SCHEMA, version=0)) == before
    untouched = set(first.inputFiles()) & set(second.inputFiles())
    assert untouched and set(second.inputFiles()) - set(first.inputFiles())
    assert em.expire_snapshots(spark, path, keep=1) == [0]
    assert plain(em.read_aggregates(spark, path)) == plain(second)
    for file in second.inputFiles():
        assert Path(file.removeprefix("file://")).exists()
    with pytest.raises(ValueError, match="version 0"):
        read_snapshot(spark, path, em.SERVING_SCHEMA, version=0)
    with pytest.raises(ValueError, match="newest"):
        em.expire_snapshots(spark, path, keep=0)


def test_of_two_loads_at_once_one_fails(spark, std, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    rows = em.window_aggregations(em.clean_events(std), LONG)
    em.replace_aggregates(rows, path)
    monkeypatch.setattr(snapshots, "_versions", lambda *_: [])  # as if the other was not there yet
    with pytest.raises(Exception, match="exist"):
        em.replace_aggregates(rows.limit(1), path)
    monkeypatch.undo()
    assert plain(em.read_aggregates(spark, path)) == plain(rows)
    assert em.replace_aggregates(rows.limit(0), path).count() == 0


def test_a_load_that_fails_before_its_commit_is_not_seen(spark, std, tmp_path, monkeypatch):
    path = str(tmp_path / "table")
    rows = em.window_aggregations(em.clean_events(std), LONG)
    em.replace_aggregates(rows, path)

    def fail(*_, **__):
        raise OSError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(snapshots, "commit", fail)
        with pytest.raises(OSError, match="lost"):
            replace_dates(rows.limit(1), path)
    assert plain(em.read_aggregates(spark, path)) == plain(rows)


def test_one_query_reads_each_message_once(spark, topic, tmp_path, expected, std):
    folder, send = topic
    send(0, 1, "garbage", 2, 3)
    [query] = run_both(spark, folder, tmp_path)
    lines = [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    assert lines == [250, 250, 1, 250, 250]
    assert rows_of(em.read_event_lake(spark, f"{tmp_path}/events")) == rows_of(em.prepare_events(std))
    assert plain(em.refresh_aggregates(spark, str(tmp_path))) == expected
    faults = em.read_faults(spark, f"{tmp_path}/faults")
    judged = em.judge_messages(em.encode_events(std).unionByName(
        spark.createDataFrame([("garbage",)], "value string")))
    assert rows_of(faults) == rows_of(em.faulty_messages(judged))
    dropped = faults.filter("dropped").count()
    assert dropped + em.read_event_lake(spark, f"{tmp_path}/events").count() == 1001


@pytest.mark.parametrize("part", ["_write_log", "faulty_messages"])
def test_a_batch_that_dies_between_its_writes_is_whole_after_all(
        spark, topic, tmp_path, expected, std, monkeypatch, part):
    folder, send = topic
    send(0, 1)
    run_both(spark, folder, tmp_path)
    send(2, 3)

    def die(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, part, die)
        with pytest.raises(Exception, match="the driver is gone"):
            run_both(spark, folder, tmp_path)
    lake = em.read_event_lake(spark, f"{tmp_path}/events")
    assert lake.count() > em.prepare_events(std).count() / 2  # the lake has the batch already
    run_both(spark, folder, tmp_path)
    assert rows_of(em.read_event_lake(spark, f"{tmp_path}/events")) == rows_of(em.prepare_events(std))
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected
    assert rows_of(em.read_faults(spark, f"{tmp_path}/faults")) == rows_of(
        em.faulty_messages(em.judge_messages(std)))


def test_an_output_of_two_queries_is_continued_by_two(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1)
    run_both(spark, folder, tmp_path, distinct="approx")
    assert len(run_both(spark, folder, tmp_path)) == 2


def test_plain_events_stream_in_one_query(spark, std, tmp_path, expected):
    std.write.json(f"{tmp_path}/in", ignoreNullFields="false")
    source = em.read_event_stream(spark, "json", {"path": f"{tmp_path}/in"})
    em.run_stream(spark, source, str(tmp_path), LONG, trigger=AVAILABLE_NOW)
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected


def test_compacting_an_empty_log_is_refused(spark, tmp_path):
    log = spark.createDataFrame([], em.AGGREGATE_LOG_SCHEMA)
    with pytest.raises(ValueError, match="empty"):
        em.compact_aggregate_log(log, str(tmp_path / "no"))


def test_look_backs_reach_the_scan_of_the_log(spark, topic, tmp_path):
    folder, send = topic
    send(0)
    run(spark, folder, tmp_path)
    log = log_of(spark, tmp_path)
    kpis = metrics.kpi_summary(em.latest_aggregates(log), as_of="2024-01-31")
    plan = kpis._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2  # rows of users and rows of states
    for scan in plan.split("FileScan")[1:]:
        assert ">= 2024-01-30" in scan.split("PartitionFilters:")[1].split("]")[0]
        assert "GreaterThanOrEqual(window_start,2024-01-30" in scan.split("PushedFilters:")[1]
    assert "SortAggregate" not in plan


def test_a_user_in_several_batches_counts_once(spark, topic, tmp_path):
    folder, send = topic
    event = {"event_type": "search", "timestamp": "2024-06-01T00:00:00", "country": "US"}
    for half in (range(0, 1500), range(500, 2000)):  # a third of the users come twice
        send("\n".join(json.dumps({**event, "user_id": f"u{i}"}) for i in half))
    run(spark, folder, tmp_path)
    whole = em.latest_aggregates(log_of(spark, tmp_path)).first()
    assert (whole["event_count"], whole["unique_users"]) == (3000, 2000)


def test_a_refresh_replaces_only_what_changed(spark, topic, tmp_path):
    folder, send = topic
    event = {"event_type": "search", "user_id": "u", "country": "US"}

    def at(*days):
        return "\n".join(json.dumps({**event, "timestamp": f"2024-06-{d:02d}T00:00:00"}) for d in days)

    def files():
        table = em.read_aggregates(spark, f"{tmp_path}/aggregates")
        return {Path(f).parent.name: f for f in table.inputFiles()}

    counts = []
    for message in (at(1, 8, 15), at(8, 8), "garbage", at(22)):  # late events for the second week
        send(message)
        run(spark, folder, tmp_path)
        em.refresh_aggregates(spark, str(tmp_path))
        counts.append(files())
        table = em.read_aggregates(spark, f"{tmp_path}/aggregates")
        assert plain(table) == plain(em.latest_aggregates(log_of(spark, tmp_path)))
    first, second, third, fourth = counts
    assert {day for day in first if first[day] != second[day]} == {"window_date=2024-06-06"}
    assert second == third and fourth.keys() - third.keys() == {"window_date=2024-06-20"}
    assert all(fourth[day] == third[day] for day in third)


def test_a_rebuild_into_the_folder_of_a_stream_is_refused(spark, topic, tmp_path, std):
    folder, send = topic
    send(0)
    run_both(spark, folder, tmp_path)
    with pytest.raises(ValueError, match="stream"):
        em.run_batch(spark, std, str(tmp_path))


def test_stream_queries_hold_for_any_span_of_time(spark, tmp_path):
    import __spark_entry__ as contract
    from eventmetrics.fixtures import TABLE_SCHEMA

    spread = spark.read.schema(TABLE_SCHEMA).parquet("/root/testdata/sf0.001/events.parquet").withColumn(
        "ts", F.expr("TIMESTAMP_NTZ '2024-01-01' + (ts - TIMESTAMP_NTZ '2024-01-01') * 8"))
    spread.write.parquet(f"{tmp_path}/events.parquet")
    queries = contract.queries()
    six_hours = rows_of(queries["windowed_aggregates_6h"](spark, str(tmp_path)))
    for name in ("stream_aggregates_6h", "stream_aggregates_two_level", "compacted_log"):
        assert rows_of(queries[name](spark, str(tmp_path))) == six_hours
    five_minutes = rows_of(queries["windowed_aggregates"](spark, str(tmp_path)))
    for name in ("stream_aggregates", "serving_table_incremental"):
        assert rows_of(queries[name](spark, str(tmp_path))) == five_minutes


def test_two_level_counts_equal_batch_once_windows_have_closed(spark, topic, tmp_path, expected):
    folder, send = topic
    sentinel = {"user_id": "z", "event_type": "search", "timestamp": "2100-01-01T00:00:00"}
    send(4, 5, 6, 7, json.dumps(sentinel))
    run(spark, folder, tmp_path, distinct="two_level", watermark="6 hours")
    log = log_of(spark, tmp_path)
    assert plain(em.latest_aggregates(log)) == expected
    assert log.groupBy(*KEY).count().filter("count > 1").count() == 0


def state_rows(spark, out):
    return spark.read.format("statestore").load(f"{out}/checkpoints/aggregate_log").count()


def test_update_mode_equals_batch_and_its_state_expires(spark, topic, tmp_path, std, expected):
    folder, send = topic
    send(4, 5, 6, 7)
    run(spark, folder, tmp_path, distinct="update", watermark="6 hours")
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected
    users = em.clean_events(std).select("user_id", "event_type", "country").distinct().count()
    held = state_rows(spark, tmp_path)
    assert 0 < held < users  # that is about one window's; there were five
    sentinel = {"user_id": "z", "event_type": "search", "timestamp": "2100-01-01T00:00:00"}
    send(json.dumps(sentinel))
    run(spark, folder, tmp_path, distinct="update", watermark="6 hours")
    assert state_rows(spark, tmp_path) == 1


def test_update_mode_counts_each_state_once(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1, 2, 3)  # these mix all times, so users' states change in every micro-batch
    run(spark, folder, tmp_path, distinct="update", watermark="60 days")
    log = log_of(spark, tmp_path)
    assert log.groupBy(*KEY, "user_id").count().filter("count > 1").count() > 0
    assert plain(em.latest_aggregates(log)) == expected
    em.compact_aggregate_log(log, f"{tmp_path}/compacted")
    compacted = em.read_aggregate_log(spark, f"{tmp_path}/compacted")
    assert compacted.count() == log.select(*KEY, "user_id").distinct().count()
    assert plain(em.latest_aggregates(compacted)) == expected
    counts = em.latest_aggregates(log, sketch=True).filter("user_sketch IS NULL").count()
    assert counts == 0  # users' states know the users


def test_update_mode_drops_what_is_later_than_the_watermark(spark, topic, tmp_path):
    folder, send = topic
    for i, number in enumerate([1, 9, 10, 1]):
        send(json.dumps({"user_id": f"u{i}", "event_type": "search",
                         "timestamp": f"2024-06-{number:02d}T00:00:00"}))
    run(spark, folder, tmp_path, distinct="update", watermark="1 day")
    rows = em.latest_aggregates(log_of(spark, tmp_path))
    assert rows.agg(F.sum("event_count"), F.sum("unique_users")).first() == (3, 3)


def test_open_windows_complete_the_log(spark, topic, tmp_path, expected):
    folder, send = topic
    log, checkpoint = f"{tmp_path}/aggregate_log", f"{tmp_path}/checkpoints/aggregate_log"
    assert em.open_windows(spark, checkpoint).count() == 0
    send(4, 5, 6, 7)
    run(spark, folder, tmp_path, distinct="two_level", watermark="6 hours")
    closed = em.latest_aggregates(log_of(spark, tmp_path)).count()
    still_open = em.open_windows(spark, checkpoint)
    assert closed and still_open.count() and closed + still_open.count() == len(expected)
    assert plain(em.windows_so_far(spark, log, checkpoint)) == expected
    # As of the first micro-batch: only the first slice, of which nothing had closed.
    first = em.prepare_events(spark.read.text(f"{folder}/000.txt"))
    assert rows_of(em.open_windows(spark, checkpoint, 0)) == plain(
        em.window_aggregations(first, LONG))
    # What the stream wrote after the batch whose state is read does not count twice.
    more = em.read_aggregate_log(spark, log).filter("batch_id >= 0").drop("batch_id")
    more.write.mode("append").partitionBy("window_date").parquet(f"{tmp_path}/later")
    ahead = spark.read.parquet(f"{tmp_path}/later").withColumn("batch_id", F.lit(99))
    ahead.write.mode("append").partitionBy("window_date", "batch_id").parquet(log)
    assert plain(em.windows_so_far(spark, log, checkpoint)) == expected


def test_windows_without_users_and_amounts_are_read_from_state(spark, topic, tmp_path):
    folder, send = topic
    events = [{"user_id": u, "event_type": "search", "timestamp": "2024-06-01T00:00:00",
               "amount": a} for u, a in (("a", None), ("a", None), ("b", None))]
    send("\n".join(map(json.dumps, events)))
    run(spark, folder, tmp_path, distinct="two_level", watermark="1 day")
    row = em.open_windows(spark, f"{tmp_path}/checkpoints/aggregate_log").first()
    assert (row["event_count"], row["unique_users"], row["total_revenue"]) == (3, 2, None)
    run(spark, folder, tmp_path / "other", distinct="approx")
    with pytest.raises(ValueError, match="two_level"):
        em.open_windows(spark, f"{tmp_path}/other/checkpoints/aggregate_log")


def test_a_watermark_drops_late_events_and_none_keeps_them(spark, topic, tmp_path):
    folder, send = topic
    day = "2024-06-{:02d}T00:00:00"
    # The last comes nine days late. The watermark of one batch decides what the next but one
    # drops, hence the event before it.
    for i, number in enumerate([1, 9, 10, 1]):
        event = {"user_id": f"u{i}", "event_type": "search", "timestamp": day.format(number),
                 "country": "US"}
        send(json.dumps(event))
    counts = {}
    for watermark in (None, "1 day"):
        out = tmp_path / str(watermark)
        run(spark, folder, out, distinct="approx", watermark=watermark)
        latest = em.latest_aggregates(log_of(spark, out))
        counts[watermark] = latest.agg(F.sum("event_count")).first()[0]
    assert counts == {None: 4, "1 day": 3}


def test_a_failing_query_stops_the_other_and_is_raised(spark, topic, tmp_path):
    folder, send = topic
    send(0)
    (tmp_path / "aggregate_log").write_text("in the way")
    with pytest.raises(Exception, match="aggregate_log"):
        run_both(spark, folder, tmp_path)
    assert not [q for q in spark.streams.active if str(tmp_path) in (q.name or "")]


def test_a_continuous_run_can_be_stopped(spark, topic, tmp_path, expected):
    folder, send = topic
    send(0, 1, 2, 3)
    queries = em.run_stream(spark, stream_of(spark, folder), str(tmp_path), LONG,
                            trigger={"processingTime": "1 second"}, wait=False)
    for query in queries:
        query.processAllAvailable()
        query.stop()
    assert plain(em.latest_aggregates(log_of(spark, tmp_path))) == expected


def test_streams_refuse_what_they_cannot_do(spark, topic):
    stream = em.prepare_events(stream_of(spark, topic[0]))
    with pytest.raises(ValueError, match="exact"):
        em.window_aggregations(stream, distinct="exact")
    with pytest.raises(ValueError, match="watermark"):
        em.window_aggregations(stream, distinct="two_level")
    with pytest.raises(ValueError, match="watermark"):
        em.window_aggregations(stream, distinct="update")
    with pytest.raises(ValueError, match="checkpoint"):
        em.write_event_lake(stream, "unused")


# --- Command line and scratch space ------------------------------------------------------


def test_command_line(spark, topic, tmp_path, capsys):
    folder, send = topic
    send(0, 1)
    out = str(tmp_path / "out")
    source = ["--format", "text", "--option", f"path={folder}"]
    main(["stream", *source, "--out", out, "--available-now"])
    main(["refresh", "--out", out])
    main(["check", "--out", out, "--freshness"])
    assert "all checks passed" in capsys.readouterr().out
    streamed = plain(em.read_aggregates(spark, f"{out}/aggregates"))
    main(["batch", *source, "--out", f"{out}/again"])
    assert plain(em.read_aggregates(spark, f"{out}/again/aggregates")) == streamed
    main(["peek", *source, "--order-by", "value", "--rows", "2"])
    assert "user_id" in capsys.readouterr().out


def fake_session(master, **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: conf.get(key, default)),
        sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session():
    cluster = fake_session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/dir/"})
    first, second = scratch_dir(cluster), scratch_dir(cluster)
    assert first.startswith("hdfs://shared/dir/eventmetrics-")
    assert first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(fake_session("yarn"))
    assert Path(scratch_dir(fake_session("local[2]"))).parent.is_dir()


# --- Late events, progress and statistics ------------------------------------------------


def test_late_events_are_kept_apart_and_add_up(spark, topic, tmp_path, expected, std):
    folder, send = topic
    send(7, 4, 5)  # the latest first, so that what follows is late
    run_both(spark, folder, tmp_path, watermark="1 hour")
    send(6)
    run_both(spark, folder, tmp_path, watermark="1 hour")  # the mark is the same after a restart
    late = em.read_late_events(spark, f"{tmp_path}/late_events")
    progress = em.read_progress(spark, f"{tmp_path}/progress").orderBy("batch_id").collect()
    log = log_of(spark, tmp_path)
    assert progress[0]["mark"] is None and progress[0]["late_events"] == 0
    assert sum(p["late_events"] for p in progress) == late.count() > 0
    assert plain(em.latest_aggregates(log)) != expected
    assert plain(em.latest_aggregates(em.with_late_events(log, late, LONG))) == expected
    assert rows_of(em.read_event_lake(spark, f"{tmp_path}/events")) == rows_of(em.prepare_events(std))
    assert plain(em.refresh_aggregates(spark, str(tmp_path), late_windows=LONG)) == expected
    # Late are the events whose window had ended an hour before the latest event so far.
    marks = {p["batch_id"]: p["mark"] for p in progress}
    for row in late.select("batch_id", F.window("event_time", LONG)["end"].alias("end")).collect():
        assert row["end"] <= marks[row["batch_id"]]


def test_a_closed_window_of_the_log_does_not_change(spark, topic, tmp_path):
    folder, send = topic
    send(0, 7)
    run_both(spark, folder, tmp_path, watermark="1 hour")
    mark = em.read_progress(spark, f"{tmp_path}/progress").agg(
        F.max("latest_event_time") - F.expr("INTERVAL 1 hour")).first()[0]
    closed = lambda: plain(em.latest_aggregates(log_of(spark, tmp_path)).filter(
        F.col("window_end") <= F.lit(mark)))
    before = closed()
    send(1, 2, 3)
    run_both(spark, folder, tmp_path, watermark="1 hour")
    assert before and closed() == before


def test_a_batch_that_dies_before_its_progress_is_late_in_the_same_way(
        spark, topic, tmp_path, expected, monkeypatch):
    folder, send = topic
    send(7)
    run_both(spark, folder, tmp_path, watermark="1 hour")
    send(4, 5, 6)

    def die(*_):
        raise OSError("the driver is gone")

    with monkeypatch.context() as broken:
        broken.setattr(sinks, "_numbers", die)
        with pytest.raises(Exception, match="the driver is gone"):
            run_both(spark, folder, tmp_path, watermark="1 hour")
    run_both(spark, folder, tmp_path, watermark="1 hour")
    late = em.read_late_events(spark, f"{tmp_path}/late_events")
    assert plain(em.latest_aggregates(em.with_late_events(log_of(spark, tmp_path), late, LONG))) == expected
    assert em.read_progress(spark, f"{tmp_path}/progress").agg(F.sum("messages")).first()[0] == 1000


def test_progress_adds_up_to_the_messages(spark, topic, tmp_path, std):
    folder, send = topic
    send(0, "garbage\n{\"user_id\":\"a\"}")
    run_both(spark, folder, tmp_path)
    send(1, 2, 3)
    run_both(spark, folder, tmp_path)
    progress = em.read_progress(spark, f"{tmp_path}/progress")
    total = progress.agg(*[F.sum(c).alias(c) for c in ("messages", "events", "dropped", "late_events")],
                         F.max("latest_event_time").alias("latest")).first()
    events = em.prepare_events(std)
    assert (total["messages"], total["late_events"]) == (1002, 0)
    assert total["events"] == events.count() == 1002 - total["dropped"]
    assert total["latest"] == events.agg(F.max("event_time")).first()[0]
    assert progress.filter("written_at IS NULL OR mark IS NOT NULL").count() == 0


def test_statistics_give_the_report_of_the_table(spark, std, tmp_path):
    path = str(tmp_path / "table")
    rows = em.window_aggregations(std, LONG).withColumn("created_at", F.col("window_end"))
    bad = rows.withColumn("event_type", F.when(F.col("country") != "US", F.col("event_type")))
    as_of = rows.agg(F.max("window_end")).first()[0].isoformat()
    for table in (rows, bad, rows.limit(0)):
        em.replace_aggregates(table, path)
        stored, known = em.read_aggregates(spark, path), em.read_statistics(spark, path)
        for how in ({}, {"freshness": True, "as_of": as_of}, {"columns": ["country", "event_type"]}):
            assert rows_of(em.report_of_statistics(known, **how)) == rows_of(
                em.quality_report(stored, **how))
        files = {f for f in known.inputFiles()}
        assert not files & set(stored.inputFiles())


def test_statistics_follow_replaced_dates_and_expire(spark, std, tmp_path):
    path = str(tmp_path / "table")
    rows = em.window_aggregations(std, "1 hour")
    table = em.replace_aggregates(rows, path)
    date = table.agg(F.min("window_date")).first()[0]
    one = table.filter(F.col("window_date") == F.lit(date)).limit(3)
    replace_dates(one, path, keep=1)
    stored = em.read_aggregates(spark, path)
    assert em.read_statistics(spark, path).agg(F.sum("rows")).first()[0] == stored.count() < rows.count()
    em.replace_aggregates(rows, path, keep=1)
    assert em.read_statistics(spark, path).agg(F.sum("rows")).first()[0] == rows.count()
    assert len(list((tmp_path / "table/_statistics").iterdir())) == 1
    em.assert_quality(em.read_statistics(spark, path))


def test_a_table_without_statistics_is_scanned(spark, std, tmp_path):
    path = str(tmp_path / "table")
    rows = em.window_aggregations(std, LONG)
    em.replace_aggregates(rows, path)
    for folder in (tmp_path / "table/_statistics").iterdir():
        folder.rename(tmp_path / folder.name)
    assert em.read_statistics(spark, path).agg(F.sum("rows")).first()[0] == rows.count()
