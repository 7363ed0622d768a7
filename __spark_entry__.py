"""

Every query reads the whole `events` table (or, with a look-back, the part that the look-back
selects). Look-backs count from the fixed time `AS_OF`, so results are repeatable.
"""

from __future__ import annotations

from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import eventmetrics as em
from eventmetrics import metrics
from eventmetrics.fixtures import AS_OF, TABLE_SCHEMA, read_std_events, std_events
from eventmetrics.functions import as_results, clock_label, compact_number, lookback
from eventmetrics.session import pin_time_zone, scratch_dir

# The language-model operators are an optional part: without their folder the rest still works.
if (find_spec("eventmetrics.llm") and find_spec("eventmetrics.llm.queries")
        and find_spec("corpus_pipeline")):
    from eventmetrics.llm import queries as llm_queries
else:
    llm_queries = None

TESTDATA = "/root/testdata"
DAY = "Last 24 Hours"
ALL_TIME = "Last 30 Days"
HOURS_6 = "6 hours"


# --- Inputs ------------------------------------------------------------------------------


def _clean(spark: SparkSession, sf_dir: str, time_window: str | None = None) -> DataFrame:
    return em.clean_events(read_std_events(pin_time_zone(spark), sf_dir, time_window))


def _aggregates(spark: SparkSession, sf_dir: str, time_window: str | None = None,
                **how) -> DataFrame:
    return em.window_aggregations(_clean(spark, sf_dir, time_window), **how)


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return em.encode_events(read_std_events(pin_time_zone(spark), sf_dir))


def _result(build: Callable[[SparkSession, str], DataFrame]):
    return lambda spark, sf_dir: as_results(build(spark, sf_dir))


def _metric(metric: Callable[..., DataFrame], time_window: str, **choices):
    """A metric over the aggregates of the events that its look-back reaches."""
    def build(spark, sf_dir):
        rows = _aggregates(spark, sf_dir, time_window)
        return metric(rows, time_window, as_of=AS_OF, **choices)

    return _result(build)


# --- Events ------------------------------------------------------------------------------


def _decoded(spark, sf_dir):
    return em.decode_events(_messages(spark, sf_dir))


def _peek(spark, sf_dir):
    events = read_std_events(pin_time_zone(spark), sf_dir)
    return em.peek_events(events, 5, events.columns)


def _enriched(spark, sf_dir):
    return em.enrich_events(_clean(spark, sf_dir))


def _purchases(spark, sf_dir):
    return em.purchase_events(_enriched(spark, sf_dir))


def _event_times(spark, sf_dir):
    events = em.with_event_time(read_std_events(pin_time_zone(spark), sf_dir))
    return events.groupBy("event_time").agg(F.count("*").alias("events"))


def _text_round_trip(spark, sf_dir):
    """Events sent as messages to text files, then read and decoded."""
    path = scratch_dir(spark)
    em.write_events(read_std_events(pin_time_zone(spark), sf_dir), "text", {"path": path})
    return em.decode_events(em.read_events(spark, "text", {"path": path}))


def _lake(spark, sf_dir):
    path = scratch_dir(spark)
    em.write_event_lake(_enriched(spark, sf_dir), path)
    return em.read_event_lake(spark, path)


# --- Aggregates --------------------------------------------------------------------------


def _approximate(spark, sf_dir):
    """Whether each group's sketched count is close to the exact one.

    Close is within a quarter, five times the sketch's standard error, or within four users.
    """
    events = _clean(spark, sf_dir)
    none = F.lit(None).cast("bigint")
    exact, sketched = (
        em.window_aggregations(events, HOURS_6, distinct) for distinct in ("exact", "approx"))
    both = (exact.withColumn("sketched", none)
            .unionByName(sketched.withColumns({"sketched": F.col("unique_users"),
                                               "unique_users": none})))
    error = F.abs(F.max("sketched") - F.max("unique_users"))
    return both.groupBy("window_start", "event_type", "country").agg(
        F.max("event_count").alias("event_count"),
        (error <= F.greatest(F.lit(4), F.max("unique_users") / 4)).alias("close"))


def _plain(table):
    """Without what only a stored table has."""
    return table.drop("created_at", "window_date", "user_sketch")


def _stored_aggregates(spark, sf_dir):
    return em.replace_aggregates(_aggregates(spark, sf_dir), scratch_dir(spark))


def _serving_table(spark, sf_dir):
    return _plain(_stored_aggregates(spark, sf_dir))


def _serving_metric(metric, *time_window, **choices):
    """A metric over the stored serving table."""
    def build(spark, sf_dir):
        as_of = {"as_of": AS_OF} if time_window else {}
        return metric(_stored_aggregates(spark, sf_dir), *time_window, **as_of, **choices)

    return _result(build)


USERS_BY = ("event_type", "country")


def _sketched(spark, sf_dir, stored: Callable[[SparkSession, str], DataFrame]):
    """Users over look-backs from merged sketches: whether they are close to the exact numbers.

    Close is within five standard errors (of 1.625 percent), or within one user.
    """
    table, events = stored(spark, sf_dir), em.with_event_time(_clean(spark, sf_dir))
    found = None
    for label in (DAY, "Last 7 Days", ALL_TIME):
        for by in USERS_BY:
            sketched = metrics.distinct_users(table, label, as_of=AS_OF, by=by)
            start = F.window("event_time", "5 minutes").getField("start")
            exact = (lookback(events.withColumn("window_start", start), label, AS_OF)
                     .groupBy(by).agg(F.count_distinct("user_id").alias("users")))
            error = F.abs(F.col("distinct_users") - F.col("users"))
            rows = exact.withColumnRenamed(by, "value").join(
                sketched.withColumnRenamed(by, "value"), "value", "full").select(
                F.lit(label).alias("time_window"), F.lit(by).alias("grouped_by"), "value", "users",
                (error <= F.greatest(F.lit(1.0), F.col("users") * 5 * 0.01625)).alias("close"))
            found = rows if found is None else found.unionByName(rows)
    return found


def _batch_table(spark, sf_dir):
    return em.run_batch(spark, _messages(spark, sf_dir), scratch_dir(spark))


def _refreshed_table(spark, sf_dir):
    out = scratch_dir(spark)
    _in_slices(spark, sf_dir, lambda path: em.run_stream(
        spark, _message_stream(spark, path), out, trigger={"availableNow": True}))
    return em.refresh_aggregates(spark, out)


def _batch_job(spark, sf_dir):
    return _plain(em.run_batch(spark, _messages(spark, sf_dir), scratch_dir(spark)))


# --- Events that a healthy table has not: derived from the given ones by their id ---------


def _odd_events(spark, sf_dir, **columns: str):
    """The events with some columns replaced by expressions of `event_id` and `value`."""
    pin_time_zone(spark)
    table = spark.read.schema(TABLE_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    odd = [F.expr(expression).alias(f"odd_{name}") for name, expression in columns.items()]
    names = [f"odd_{name}" for name in columns]
    events = std_events(table.select("*", *odd), *names)
    return events.withColumns({name: F.col(f"odd_{name}") for name in columns}).drop(*names)


# Multiples of 2 * 10^10, thousandths, and half cents.
_EXTREMES = """CASE event_id % 3 WHEN 0 THEN (event_id % 7) * CAST(20000000000 AS DOUBLE)
  WHEN 1 THEN value / 1000 ELSE value + 0.005 END"""


def _extremes(spark, sf_dir):
    events = _odd_events(spark, sf_dir, amount=_EXTREMES)
    return em.window_aggregations(em.clean_events(events), HOURS_6)


def _bad_amounts(spark, sf_dir):
    return em.check_amounts(_odd_events(
        spark, sf_dir, amount="IF(event_id % 50 = 0, CAST('NaN' AS DOUBLE), value)"))


def _no_country(spark, sf_dir):
    country = "CASE WHEN event_id % 3 > 0 THEN 'C' || (event_id % 3) END"
    return em.window_aggregations(
        em.clean_events(_odd_events(spark, sf_dir, country=country)), HOURS_6)


def _unparseable_times(spark, sf_dir):
    time = """IF(event_id % 11 = 0, 'garbage', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))"""
    events = em.with_event_time(_odd_events(spark, sf_dir, timestamp=time))
    return events.groupBy("event_time").agg(F.count("*").alias("events"))


def _broken_messages(spark, sf_dir):
    """Messages of which two thirds are broken in four ways."""
    kind = _odd_events(spark, sf_dir, kind="event_id % 6")
    whole = F.to_json(F.struct(*em.EVENT_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    mistyped = F.to_json(F.struct(*[c for c in em.EVENT_SCHEMA.fieldNames() if c != "amount"],
                                  F.lit("x").alias("amount")))
    message = (F.when(F.col("kind") == 0, F.lit("garbage")).when(F.col("kind") == 1, F.lit(None))
               .when(F.col("kind") == 2, F.lit('{"user_id":"b"'))
               .when(F.col("kind") == 3, mistyped)
               .when(F.col("kind") == 4, F.concat(F.lit('{"extra":1,'), F.substr(whole, F.lit(2))))
               .otherwise(whole))
    return kind.select(message.alias("value"))


def _bad_messages(spark, sf_dir):
    return em.clean_events(em.decode_events(_broken_messages(spark, sf_dir)))


def _faults(spark, sf_dir):
    return em.faulty_messages(em.judge_messages(_broken_messages(spark, sf_dir)))


def _empty_report(spark, sf_dir):
    return em.quality_report(_written(spark, sf_dir).filter("event_type = 'none'"), as_of=AS_OF,
                             freshness=True)


# --- Streams -----------------------------------------------------------------------------

SLICES = 3
# A message from the far future, after which the watermark has passed every window.
SENTINEL = (
    '{"user_id":"sentinel","event_type":"page_view","timestamp":"2100-01-01T00:00:00",'
    '"country":"US"}'
)


def _times(spark: SparkSession, sf_dir: str):
    return spark.read.schema(TABLE_SCHEMA).parquet(f"{sf_dir}/events.parquet").agg(
        F.min("ts"), F.max("ts")).first()


def _in_slices(spark: SparkSession, sf_dir: str, run: Callable[[str], None],
               by_time: bool = False) -> None:
    """Send all events as message files in slices, with a run of the stream after each.

    A micro-batch takes all of a slice, however many files it has, so that all tasks have work.
    Slices mix all times or, `by_time`, follow it.
    """
    path = scratch_dir(spark)
    messages = _messages(spark, sf_dir)
    slice_of = F.pmod(F.xxhash64("value"), F.lit(SLICES))
    if by_time:
        first, last = _times(spark, sf_dir)
        share = (F.unix_seconds(F.try_to_timestamp(F.get_json_object("value", "$.timestamp")))
                 - F.unix_seconds(F.lit(first).cast("timestamp"))) / (
            ((last - first).total_seconds() if first else 0) + 1)
        slice_of = F.coalesce(F.least(F.floor(share * SLICES), F.lit(SLICES - 1)), F.lit(0))
    for number in range(SLICES):
        (messages.filter(slice_of == number)
            .write.text(f"{path}/slice={number}"))
        run(path)


def _message_stream(spark: SparkSession, path: str) -> DataFrame:
    return em.read_event_stream(spark, "text", {"path": f"{path}/slice=*"})


def _stream_lake(spark, sf_dir):
    out = scratch_dir(spark)

    def run(path):
        events = em.prepare_events(_message_stream(spark, path))
        em.write_event_lake(events, f"{out}/events", f"{out}/checkpoint",
                            {"availableNow": True}).awaitTermination()

    _in_slices(spark, sf_dir, run)
    return em.read_event_lake(spark, f"{out}/events")


def _stream_log(spark: SparkSession, sf_dir: str, duration: str) -> DataFrame:
    out = scratch_dir(spark)

    def run(path):
        events = em.prepare_events(_message_stream(spark, path))
        em.write_aggregate_log(em.window_aggregations(events, duration), f"{out}/log",
                               f"{out}/checkpoint", {"availableNow": True}).awaitTermination()

    _in_slices(spark, sf_dir, run)
    return em.read_aggregate_log(spark, f"{out}/log")


def _stream_aggregates(spark, sf_dir):
    return _plain(em.latest_aggregates(_stream_log(spark, sf_dir, HOURS_6)))


def _log_metric(metric, time_window: str):
    def build(spark, sf_dir):
        log = em.latest_aggregates(_stream_log(spark, sf_dir, "5 minutes"))
        return metric(log, time_window, as_of=AS_OF)

    return _result(build)


def _stream_job(spark, sf_dir):
    """Both outputs of the stream, then the serving table."""
    out = scratch_dir(spark)
    _in_slices(spark, sf_dir, lambda path: em.run_stream(
        spark, _message_stream(spark, path), out, trigger={"availableNow": True}))
    return _plain(em.refresh_aggregates(spark, out))


def _serving_incremental(spark, sf_dir):
    """The serving table after a refresh for each slice: later ones add rows to old dates."""
    out = scratch_dir(spark)

    def run(path):
        events = em.prepare_events(_message_stream(spark, path))
        em.write_aggregate_log(em.window_aggregations(events), f"{out}/aggregate_log",
                               f"{out}/checkpoint", {"availableNow": True}).awaitTermination()
        em.refresh_aggregates(spark, out)

    _in_slices(spark, sf_dir, run)
    return _plain(em.read_aggregates(spark, f"{out}/aggregates"))


def _refresh_after_compaction(spark, sf_dir):
    """A refresh after the first slice, and one after the last, before which the log is compacted."""
    out, log, compacted = scratch_dir(spark), scratch_dir(spark), scratch_dir(spark)
    runs = []

    def run(path):
        events = em.prepare_events(_message_stream(spark, path))
        em.write_aggregate_log(em.window_aggregations(events), log, f"{out}/checkpoint",
                               {"availableNow": True}).awaitTermination()
        runs.append(path)
        if len(runs) == 1:
            em.refresh_aggregates(spark, out, log_path=log)

    _in_slices(spark, sf_dir, run)
    em.compact_aggregate_log(em.read_aggregate_log(spark, log), compacted)
    return _plain(em.refresh_aggregates(spark, out, log_path=compacted))


def _stream_faults(spark, sf_dir):
    """What the stream's one query keeps of messages with a fault."""
    out, path = scratch_dir(spark), scratch_dir(spark)
    _broken_messages(spark, sf_dir).write.json(path, ignoreNullFields="false")
    messages = spark.readStream.schema("value STRING").json(path)
    em.run_stream(spark, messages, out, trigger={"availableNow": True})
    return em.read_faults(spark, f"{out}/faults")


def _stream_with_late(spark, sf_dir):
    """A stream that closes windows after a day, then its log together with the late events."""
    out = scratch_dir(spark)
    _in_slices(spark, sf_dir, lambda path: em.run_stream(
        spark, _message_stream(spark, path), out, watermark="1 day", trigger={"availableNow": True}))
    late = em.read_late_events(spark, f"{out}/late_events")
    log = em.read_aggregate_log(spark, f"{out}/aggregate_log")
    return _plain(em.latest_aggregates(em.with_late_events(log, late)))


def _stream_progress(spark, sf_dir):
    """What a stream that was started again for each slice did in all."""
    out = scratch_dir(spark)
    _in_slices(spark, sf_dir, lambda path: em.run_stream(
        spark, _message_stream(spark, path), out, trigger={"availableNow": True}))
    return em.read_progress(spark, f"{out}/progress").agg(
        *[F.sum(c).alias(c) for c in ("messages", "events", "dropped", "faulty_events")],
        F.max("latest_event_time").alias("latest_event_time"))


def _stored_report(spark, sf_dir):
    """The report on a stored table, without a scan of it."""
    path = scratch_dir(spark)
    em.replace_aggregates(_written(spark, sf_dir), path)
    return em.report_of_statistics(em.read_statistics(spark, path), as_of=AS_OF, freshness=True)


def _first_snapshot(spark, sf_dir):
    """A table as it was for a reader that began before it was replaced."""
    path = scratch_dir(spark)
    table = em.replace_aggregates(_aggregates(spark, sf_dir), path)
    em.replace_aggregates(table.filter("event_type = 'search'"), path)
    return _plain(table)


def _compacted_log(spark, sf_dir):
    path = scratch_dir(spark)
    em.compact_aggregate_log(_stream_log(spark, sf_dir, HOURS_6), path)
    return _plain(em.latest_aggregates(em.read_aggregate_log(spark, path)))


def _stream_two_level(spark, sf_dir):
    """The slices mix all times, so the watermark stays behind by as much as the times span."""
    out = scratch_dir(spark)
    times = _times(spark, sf_dir)
    days = (times[1] - times[0]).days + 2 if times[0] else 1
    paths = []

    def run(path):
        paths.append(path)
        events = em.prepare_events(_message_stream(spark, path))
        aggregates = em.window_aggregations(events, HOURS_6, "two_level", f"{days} days")
        query = em.write_aggregate_log(aggregates, f"{out}/log", f"{out}/checkpoint",
                                       {"availableNow": True}, "append")
        query.awaitTermination()
        late = sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress
                   for state in progress["stateOperators"])
        if late:
            raise ValueError(f"{late} rows came later than the watermark")

    _in_slices(spark, sf_dir, run)
    (spark.range(1).select(F.lit(SENTINEL).alias("value"))
        .write.text(f"{paths[0]}/slice={SLICES}"))
    run(paths[0])
    log = em.read_aggregate_log(spark, f"{out}/log")
    return _plain(em.latest_aggregates(log))


def _stream_by_time(spark: SparkSession, sf_dir: str, distinct: str, output_mode: str) -> str:
    """A stream with state whose windows close on the way; returns where its outputs are."""
    out = scratch_dir(spark)

    def run(path):
        aggregates = em.window_aggregations(
            em.prepare_events(_message_stream(spark, path)), HOURS_6, distinct, "1 day")
        em.write_aggregate_log(aggregates, f"{out}/log", f"{out}/checkpoint",
                               {"availableNow": True}, output_mode).awaitTermination()

    _in_slices(spark, sf_dir, run, by_time=True)
    return out


def _stream_update(spark, sf_dir):
    out = _stream_by_time(spark, sf_dir, "update", "update")
    return _plain(em.latest_aggregates(em.read_aggregate_log(spark, f"{out}/log")))


def _stream_open_windows(spark, sf_dir):
    """Windows that closed, from the log, and those of the last day, from the state."""
    out = _stream_by_time(spark, sf_dir, "two_level", "append")
    return _plain(em.windows_so_far(spark, f"{out}/log", f"{out}/checkpoint"))


# --- Metrics and quality -----------------------------------------------------------------


def _options(metric):
    return _result(lambda spark, sf_dir: metric(_aggregates(spark, sf_dir)))


def _cards(**choices):
    kpis = _metric(metrics.kpi_summary, DAY, **choices)
    return lambda spark, sf_dir: metrics.kpi_cards(kpis(spark, sf_dir))


def _live_feed(**choices):
    return _result(lambda spark, sf_dir: metrics.live_feed(_aggregates(spark, sf_dir), **choices))


def _compact_numbers(spark, sf_dir):
    daily = _aggregates(spark, sf_dir, duration="1 day")
    return daily.select("window_start", "event_type", "country",
                        compact_number("total_revenue", "$").alias("revenue_text"),
                        compact_number(F.col("event_count") * 12345, "", "!").alias("count_text"))


def _clock_labels(spark, sf_dir):
    return (_aggregates(spark, sf_dir).groupBy(clock_label("window_start").alias("label"))
            .agg(F.sum("event_count").alias("event_count")))


# --- Checks: aggregates are taken to have been written when their window ended -----------


def _written(spark, sf_dir):
    return _aggregates(spark, sf_dir).withColumn("created_at", F.col("window_end"))


def _report(as_of: str):
    return lambda spark, sf_dir: em.quality_report(
        _written(spark, sf_dir), as_of=as_of, freshness=True)


# --- The contract ------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Five-minute aggregates of the smallest data set."""
    return as_results(_aggregates(spark, f"{TESTDATA}/sf0.001"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query by name; each takes the session and the folder of the tables."""
    found = {
        # Sources, codecs and row operators
        "std_events": _result(lambda spark, sf: read_std_events(pin_time_zone(spark), sf)),
        "decode_events": _result(_decoded),
        "peek_events": _result(_peek),
        "text_round_trip": _result(_text_round_trip),
        "clean_events": _result(_clean),
        "event_times": _result(_event_times),
        "enrich_events": _result(_enriched),
        "purchase_events": _result(_purchases),
        # Window aggregates
        "windowed_aggregates": _result(_aggregates),
        "windowed_aggregates_6h": _result(
            lambda spark, sf: _aggregates(spark, sf, duration=HOURS_6)),
        "windowed_aggregates_6h_set": _result(
            lambda spark, sf: _aggregates(spark, sf, duration=HOURS_6, distinct="set")),
        "windowed_aggregates_6h_two_level": _result(
            lambda spark, sf: _aggregates(spark, sf, duration=HOURS_6, distinct="two_level")),
        "windowed_aggregates_6h_approx": _result(_approximate),
        # Sinks and jobs
        "event_lake": _result(_lake),
        "serving_table": _result(_serving_table),
        "serving_table_incremental": _result(_serving_incremental),
        "batch_job": _result(_batch_job),
        "stream_event_lake": _result(_stream_lake),
        "stream_aggregates": _result(_stream_job),
        "stream_aggregates_6h": _result(_stream_aggregates),
        "stream_aggregates_two_level": _result(_stream_two_level),
        "stream_aggregates_update": _result(_stream_update),
        "stream_open_windows": _result(_stream_open_windows),
        "compacted_log": _result(_compacted_log),
        "distinct_users_batch": lambda spark, sf: _sketched(spark, sf, _batch_table),
        "distinct_users_stream": lambda spark, sf: _sketched(spark, sf, _refreshed_table),
        "refresh_after_compaction": _result(_refresh_after_compaction),
        "serving_table_before_replace": _result(_first_snapshot),
        "stream_late_events": _result(_stream_with_late),
        "stream_progress": _result(_stream_progress),
        "faulty_messages": _faults,
        "stream_faults": _stream_faults,
        # Events with faults
        "revenue_extremes": _result(_extremes),
        "check_amounts_bad": _bad_amounts,
        "check_amounts": lambda spark, sf: em.check_amounts(
            read_std_events(pin_time_zone(spark), sf)),
        "decode_bad_messages": _result(_bad_messages),
        "event_times_unparseable": _result(_unparseable_times),
        "windowed_aggregates_null_country": _result(_no_country),
        "filter_countries_null": _result(
            lambda spark, sf: metrics.filter_countries(_no_country(spark, sf))),
        # Metrics on the stored serving table and on the stream's log
        "serving_kpi_summary": _serving_metric(metrics.kpi_summary, DAY),
        "serving_events_over_time": _serving_metric(metrics.events_over_time, "Last 7 Days"),
        "serving_live_feed": _serving_metric(metrics.live_feed),
        "log_kpi_summary": _log_metric(metrics.kpi_summary, DAY),
        # Metrics
        "filter_event_types": _options(metrics.filter_event_types),
        "filter_countries": _options(metrics.filter_countries),
        "kpi_summary": _metric(metrics.kpi_summary, DAY),
        "kpi_summary_filtered": _metric(
            metrics.kpi_summary, DAY, event_type="purchase", country="US"),
        "kpi_summary_empty": _metric(metrics.kpi_summary, DAY, event_type="no such type"),
        "kpi_cards": _cards(),
        "kpi_cards_empty": _cards(event_type="no such type"),
        "event_type_distribution": _metric(metrics.event_type_distribution, ALL_TIME),
        "event_type_distribution_country": _metric(
            metrics.event_type_distribution, "Last 7 Days", country="DE"),
        "event_type_share": _metric(metrics.event_type_share, ALL_TIME),
        "revenue_by_event_type": _metric(metrics.revenue_by_event_type, "Last 6 Hours"),
        "top_countries": _metric(metrics.top_countries, ALL_TIME),
        "top_countries_purchase": _metric(
            metrics.top_countries, "Last 7 Days", event_type="purchase", n=3),
        "top_countries_ascending": _metric(metrics.top_countries_ascending, ALL_TIME),
        "purchase_trends": _metric(metrics.purchase_trends, "Last 7 Days"),
        "purchase_trends_country": _metric(metrics.purchase_trends, ALL_TIME, country="JP"),
        "live_feed": _live_feed(),
        "live_feed_labelled": _live_feed(limit=50, with_label=True),
        "compact_numbers": _result(_compact_numbers),
        "clock_labels": _result(_clock_labels),
        # Quality
        "check_row_count": lambda spark, sf: em.check_row_count(_aggregates(spark, sf)),
        "check_nulls": lambda spark, sf: em.check_nulls(_aggregates(spark, sf)),
        "check_nulls_raw": lambda spark, sf: em.check_nulls(
            read_std_events(pin_time_zone(spark), sf), ["user_id", "event_type"]),
        "check_freshness": lambda spark, sf: em.check_freshness(_written(spark, sf), AS_OF),
        "quality_report": _report(AS_OF),
        "quality_report_stale": _report(LATER),
        "quality_report_empty": _empty_report,
        "quality_report_stored": _stored_report,
        "events_over_time_filtered": _metric(
            metrics.events_over_time, "Last 7 Days", event_type="search", country="US"),
    }
    for name, (label, _, _) in SERIES.items():
        found[name] = _metric(metrics.events_over_time, label)
    if llm_queries:
        found |= llm_queries.QUERIES
    return found


# --- The same in SQL ---------------------------------------------------------------------

LATER = "2024-03-01 00:00:00"

# Label, its look-back and its bucket, for each time-series query.
SERIES = {
    "events_over_time_1h": ("Last 1 Hour", "1 hour", "10 minutes"),
    "events_over_time_6h": ("Last 6 Hours", "6 hours", "30 minutes"),
    "events_over_time_24h": ("Last 24 Hours", "24 hours", "1 hour"),
    "events_over_time_7d": ("Last 7 Days", "7 days", "1 hour"),
    "events_over_time_30d": ("Last 30 Days", "30 days", "6 hours"),
    "events_over_time_other": ("Any other label", "24 hours", "6 hours"),
}

_STD = """
std AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
         CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'search'
              WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS event_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp",
         's' || (user_id % 1000) AS session_id,
         (['mobile','desktop','tablet'])[event_id % 3 + 1] AS device,
         '/p/' || json_extract_string(props, '$.k') AS page,
         (['US','GB','DE','FR','CA','AU','IN','BR','JP','MX',
           'ES','IT','NL','SE','SG','KR','PL','TR','ZA','AR'])[user_id % 20 + 1] AS country,
         CASE WHEN event_id % 10 >= 7 THEN value END AS amount
  FROM events
)"""
_CLEAN = f"""{_STD},
clean AS (
  SELECT * FROM std
  WHERE user_id IS NOT NULL AND event_type IS NOT NULL AND "timestamp" IS NOT NULL
    AND event_type IN ('page_view', 'search', 'add_to_cart', 'purchase', 'logout')
)"""
_ENRICHED = f"""{_CLEAN},
enriched AS (
  SELECT *, CAST("timestamp" AS TIMESTAMP) AS event_time,
         CAST("timestamp" AS DATE) AS event_date,
         CAST(hour(CAST("timestamp" AS TIMESTAMP)) AS INTEGER) AS event_hour,
         event_type = 'purchase' AS is_purchase
  FROM clean
)"""


def _agg_cte(duration: str = "5 minutes", clean: str = _CLEAN,
             revenue: str = "SUM(CAST(amount AS DECIMAL(12,2)))") -> str:
    start = f"""time_bucket(INTERVAL '{duration}', CAST("timestamp" AS TIMESTAMP))"""
    return f"""{clean},
agg AS (
  SELECT {start} AS window_start, {start} + INTERVAL '{duration}' AS window_end,
         event_type, country, COUNT(*) AS event_count,
         COUNT(DISTINCT user_id) AS unique_users,
         {revenue} AS total_revenue
  FROM clean GROUP BY ALL
)"""


def _odd_clean(**columns: str) -> str:
    """The common tables with some columns of `std` replaced, as `_odd_events` does."""
    odd = _CLEAN
    given = {"amount": "CASE WHEN event_id % 10 >= 7 THEN value END AS amount",
             "timestamp": """strftime(ts, '%Y-%m-%dT%H:%M:%S') AS "timestamp\"""",
             "country": _STD[_STD.index("         (['US'"):_STD.index(",\n         CASE WHEN event_id % 10")].strip()}
    for name, expression in columns.items():
        odd = odd.replace(given[name], f'{expression} AS "{name}"')
    return odd


def _aggregates_sql(duration: str = "5 minutes", **how: str) -> str:
    return f"""WITH {_agg_cte(duration, **how)}
SELECT window_start, window_end, event_type, country, event_count, unique_users,
       CAST(total_revenue AS DOUBLE) AS total_revenue
FROM agg"""


def _since(length: str, where: str = "TRUE") -> str:
    return f"window_start >= TIMESTAMP '{AS_OF}' - INTERVAL '{length}' AND {where}"


_NO_COUNTRY = _odd_clean(country="CASE WHEN event_id % 3 > 0 THEN 'C' || (event_id % 3) END")
_CLEAN_WITH_ID = _CLEAN.replace("  FROM events", "         , event_id\n  FROM events")
_EVENT_COUNT = "CAST(SUM(event_count) AS BIGINT)"
_USERS = "CAST(SUM(unique_users) AS BIGINT) AS unique_users"
_REVENUE = "CAST(COALESCE(SUM(total_revenue), 0) AS DOUBLE)"


def _kpi_sql(where: str = "TRUE") -> str:
    return f"""
  SELECT CAST(COALESCE(SUM(event_count), 0) AS BIGINT) AS total_events,
         CAST(COALESCE(SUM(unique_users), 0) AS BIGINT) AS total_unique_users,
         {_REVENUE} AS total_revenue,
         CAST(COUNT(DISTINCT country) AS INTEGER) AS active_countries
  FROM agg WHERE {_since('24 hours', where)}"""


def _compact_sql(n: str, prefix: str = "", suffix: str = "") -> str:
    n = f"CAST({n} AS DOUBLE)"
    return f"""CASE WHEN {n} IS NULL THEN '—'
      WHEN {n} >= 1e6 THEN '{prefix}' || format('{{:.1f}}', {n} / 1e6) || 'M{suffix}'
      WHEN {n} >= 1e3 THEN '{prefix}' || format('{{:.1f}}', {n} / 1e3) || 'K{suffix}'
      ELSE '{prefix}' || format('{{:,.0f}}', {n}) || '{suffix}' END"""


def _distinct_users_sql() -> str:
    parts = [f"""SELECT '{label}' AS time_window, '{by}' AS grouped_by, {by} AS value,
       COUNT(DISTINCT user_id) AS users, TRUE AS close
FROM dated WHERE {_since(length)} GROUP BY {by}"""
             for label, length in ((DAY, "24 hours"), ("Last 7 Days", "7 days"), (ALL_TIME, "30 days"))
             for by in USERS_BY]
    start = """time_bucket(INTERVAL '5 minutes', CAST("timestamp" AS TIMESTAMP))"""
    return (f"WITH {_CLEAN}, dated AS (SELECT *, {start} AS window_start FROM clean)\n"
            + "\nUNION ALL\n".join(parts))


def _cards_sql(where: str = "TRUE") -> str:
    def card(column, prefix=""):
        shown = f"CASE WHEN total_events > 0 THEN {column} END"
        return f"{_compact_sql(shown, prefix)} AS {column}"

    return f"""WITH {_agg_cte()}, kpi AS ({_kpi_sql(where)})
SELECT {card('total_events')}, {card('total_unique_users')}, {card('total_revenue', '$')},
       {card('active_countries')}
FROM kpi"""


def _distribution_sql(length: str, where: str = "TRUE") -> str:
    return f"""
  SELECT event_type, {_EVENT_COUNT} AS event_count, {_USERS}, {_REVENUE} AS revenue
  FROM agg WHERE {_since(length, where)} GROUP BY event_type"""


def _top_sql(length: str, n: int, where: str = "TRUE") -> str:
    return f"""WITH {_agg_cte()}
SELECT country, {_EVENT_COUNT} AS event_count, {_REVENUE} AS revenue
FROM agg WHERE {_since(length, where)} GROUP BY country
ORDER BY event_count DESC, country ASC NULLS LAST LIMIT {n}"""


def _series_sql(length: str, bucket: str, where: str = "TRUE") -> str:
    return f"""WITH {_agg_cte()}
SELECT time_bucket(INTERVAL '{bucket}', window_start) AS bucket,
       {_EVENT_COUNT} AS event_count, {_USERS}, {_REVENUE} AS revenue
FROM agg WHERE {_since(length, where)} GROUP BY 1 ORDER BY 1"""


def _trend_sql(length: str, where: str = "TRUE") -> str:
    return f"""WITH {_agg_cte()}
SELECT date_trunc('hour', window_start) AS hour, {_REVENUE} AS revenue,
       {_EVENT_COUNT} AS purchases
FROM agg WHERE {_since(length, f"event_type = 'purchase' AND {where}")}
GROUP BY 1 ORDER BY 1"""


def _feed_sql(n: int, label: str = "") -> str:
    return f"""WITH {_agg_cte()}
SELECT window_start, event_type, country, event_count, unique_users,
       CAST(COALESCE(total_revenue, 0) AS DOUBLE) AS total_revenue{label}
FROM agg
ORDER BY window_start DESC NULLS FIRST, event_type ASC NULLS LAST, country ASC NULLS LAST
LIMIT {n}"""


def _options_sql(column: str) -> str:
    return f"""WITH {_agg_cte()}
SELECT 'All' AS {column} UNION ALL (SELECT DISTINCT {column} FROM agg)"""


def _checks_sql(cte: str, table: str, *checks: tuple[str, str, str, str]) -> str:
    """Checks in order: name, what it counts, when that fails, what it says then."""
    counts = ", ".join(f"{count} AS c_{name}" for name, count, _, _ in checks)
    rows, before = [], "FALSE"
    for name, _, fails, complaint in checks:
        bad = f"c_{name} {fails}"
        rows.append(f"""SELECT '{name}' AS "check",
       CASE WHEN NOT ({before}) THEN c_{name} END AS observed,
       CASE WHEN {before} THEN 'skipped' WHEN {bad} THEN 'failed' ELSE 'passed' END AS status,
       CASE WHEN {before} THEN 'an earlier check failed' WHEN {bad} THEN '{complaint}'
            ELSE 'ok' END AS message
FROM counts""")
        before += f" OR {bad}"
    return (f"WITH {cte}, counts AS (SELECT {counts} FROM {table})\n"
            + "\nUNION ALL\n".join(rows))


def _row_count_check():
    return ("row_count", "COUNT(*)", "= 0", "the table is empty")


def _null_check(first: str, second: str):
    return ("nulls", f"COUNT(*) FILTER (WHERE {first} IS NULL OR {second} IS NULL)", "> 0",
            "rows lack a required value")


def _freshness_check(as_of: str):
    return ("freshness",
            f"COUNT(*) FILTER (WHERE window_end > TIMESTAMP '{as_of}' - INTERVAL '1 day')",
            "= 0", "nothing was written within 1 day")


def _amount_check(bad: str):
    return ("amounts", f"COUNT(*) FILTER (WHERE {bad})", "> 0",
            "amounts are not numbers that can be added up")


def _full_checks_sql(as_of: str, table: str = "agg") -> str:
    return _checks_sql(_agg_cte(), table, _row_count_check(), _freshness_check(as_of),
                       _null_check("event_type", "window_start"))


def oracle_sql() -> dict[str, str]:
    """For each query, the SQL that has the same result."""
    std = f"WITH {_STD}\nSELECT * FROM std"
    enriched = f"WITH {_ENRICHED}\nSELECT * FROM enriched"
    order = ", ".join(f'"{c}" ASC NULLS FIRST' for c in em.EVENT_SCHEMA.fieldNames())
    five_minutes, six_hours = _aggregates_sql(), _aggregates_sql(HOURS_6)
    nobody = "event_type = 'no such type'"
    share = f"""WITH {_agg_cte()}, dist AS ({_distribution_sql('30 days')}),
total AS (SELECT CAST(SUM(event_count) AS BIGINT) AS total_events FROM dist)
SELECT event_type, event_count, total_events,
       CAST(100 AS DOUBLE) * event_count / total_events AS percent
FROM dist CROSS JOIN total"""
    found = {
        "std_events": std,
        "decode_events": std,
        "text_round_trip": std,
        "peek_events": f"{std} ORDER BY {order} LIMIT 5",
        "clean_events": f"WITH {_CLEAN}\nSELECT * FROM clean",
        "event_times": f"""WITH {_STD}
SELECT CAST("timestamp" AS TIMESTAMP) AS event_time, COUNT(*) AS events FROM std GROUP BY 1""",
        "enrich_events": enriched,
        "event_lake": enriched,
        "stream_event_lake": enriched,
        "purchase_events": f"{enriched} WHERE is_purchase",
        "windowed_aggregates": five_minutes,
        "serving_table": five_minutes,
        "serving_table_incremental": five_minutes,
        "refresh_after_compaction": five_minutes,
        "serving_table_before_replace": five_minutes,
        "revenue_extremes": _aggregates_sql(
            HOURS_6, clean=_odd_clean(amount=_EXTREMES),
            revenue="ROUND(SUM(CAST(amount AS DECIMAL(38,6))), 2)"),
        "check_amounts": _checks_sql(_STD, "std", _amount_check("FALSE")),
        "check_amounts_bad": _checks_sql(
            "std AS (SELECT * FROM events)", "std", _amount_check("event_id % 50 = 0")),
        "decode_bad_messages": f"""WITH {_CLEAN_WITH_ID}
SELECT * EXCLUDE (event_id, amount), CASE WHEN event_id % 6 > 3 THEN amount END AS amount
FROM clean WHERE event_id % 6 > 2""",
        "distinct_users_batch": _distinct_users_sql(),
        "distinct_users_stream": _distinct_users_sql(),
        "stream_late_events": five_minutes,
        "stream_progress": f"""WITH {_ENRICHED}, everything AS (SELECT COUNT(*) AS messages FROM std)
SELECT messages, COUNT(event_type) AS events, messages - COUNT(event_type) AS dropped,
       CAST(0 AS BIGINT) AS faulty_events, MAX(event_time) AS latest_event_time
FROM everything LEFT JOIN enriched ON TRUE GROUP BY messages""",
        "faulty_messages": _FAULTS,
        "stream_faults": _FAULTS,
        "event_times_unparseable": """SELECT CASE WHEN event_id % 11 > 0 THEN date_trunc('second', ts)
       END AS event_time, COUNT(*) AS events FROM events GROUP BY 1""",
        "windowed_aggregates_null_country": _aggregates_sql(HOURS_6, clean=_NO_COUNTRY),
        "filter_countries_null": f"""WITH {_agg_cte(HOURS_6, clean=_NO_COUNTRY)}
SELECT 'All' AS country UNION ALL (SELECT DISTINCT country FROM agg)""",
        "serving_kpi_summary": f"WITH {_agg_cte()} {_kpi_sql()}",
        "log_kpi_summary": f"WITH {_agg_cte()} {_kpi_sql()}",
        "serving_events_over_time": _series_sql("7 days", "1 hour"),
        "serving_live_feed": _feed_sql(20),
        "events_over_time_filtered": _series_sql(
            "7 days", "1 hour", "event_type = 'search' AND country = 'US'"),
        "quality_report_empty": _full_checks_sql(AS_OF, "agg WHERE event_type = 'none'"),
        "batch_job": five_minutes,
        "stream_aggregates": five_minutes,
        "windowed_aggregates_6h": six_hours,
        "windowed_aggregates_6h_set": six_hours,
        "windowed_aggregates_6h_two_level": six_hours,
        "stream_aggregates_6h": six_hours,
        "stream_aggregates_two_level": six_hours,
        "stream_aggregates_update": six_hours,
        "stream_open_windows": six_hours,
        "compacted_log": six_hours,
        "windowed_aggregates_6h_approx": f"""WITH {_agg_cte(HOURS_6)}
SELECT window_start, event_type, country, event_count, TRUE AS close FROM agg""",
        "filter_event_types": _options_sql("event_type"),
        "filter_countries": _options_sql("country"),
        "kpi_summary": f"WITH {_agg_cte()} {_kpi_sql()}",
        "kpi_summary_filtered":
            f"WITH {_agg_cte()} {_kpi_sql(_FILTERED)}",
        "kpi_summary_empty": f"WITH {_agg_cte()} {_kpi_sql(nobody)}",
        "kpi_cards": _cards_sql(),
        "kpi_cards_empty": _cards_sql(nobody),
        "event_type_distribution": f"WITH {_agg_cte()} {_distribution_sql('30 days')}",
        "event_type_distribution_country":
            f"""WITH {_agg_cte()} {_distribution_sql('7 days', "country = 'DE'")}""",
        "event_type_share": share,
        "revenue_by_event_type":
            f"""WITH {_agg_cte()}, dist AS ({_distribution_sql('6 hours')})
SELECT * FROM dist WHERE revenue > 0""",
        "top_countries": _top_sql("30 days", 10),
        "top_countries_ascending": _top_sql("30 days", 10),
        "top_countries_purchase": _top_sql("7 days", 3, "event_type = 'purchase'"),
        "purchase_trends": _trend_sql("7 days"),
        "purchase_trends_country": _trend_sql("30 days", "country = 'JP'"),
        "live_feed": _feed_sql(20),
        "live_feed_labelled": _feed_sql(50, ", strftime(window_start, '%H:%M:%S') AS label"),
        "compact_numbers": f"""WITH {_agg_cte('1 day')}
SELECT window_start, event_type, country,
       {_compact_sql('total_revenue', '$')} AS revenue_text,
       {_compact_sql('event_count * 12345', '', '!')} AS count_text
FROM agg""",
        "clock_labels": f"""WITH {_agg_cte()}
SELECT strftime(window_start, '%H:%M:%S') AS label, {_EVENT_COUNT} AS event_count
FROM agg GROUP BY 1""",
        "check_row_count": _checks_sql(_agg_cte(), "agg", _row_count_check()),
        "check_nulls": _checks_sql(
            _agg_cte(), "agg", _null_check("event_type", "window_start")),
        "check_nulls_raw": _checks_sql(_STD, "std", _null_check("user_id", "event_type")),
        "check_freshness": _checks_sql(_agg_cte(), "agg", _freshness_check(AS_OF)),
        "quality_report": _full_checks_sql(AS_OF),
        "quality_report_stale": _full_checks_sql(LATER),
        "quality_report_stored": _full_checks_sql(AS_OF),
    }
    for name, (_, length, bucket) in SERIES.items():
        found[name] = _series_sql(length, bucket)
    if llm_queries:
        found |= llm_queries.ORACLE_SQL
    return found


_TEXTS = ("user_id", "event_type", "timestamp", "session_id", "device", "page", "country")


def _message_sql(nulls: bool, last: str) -> str:
    """The events' JSON text, with or without the fields that are NULL."""
    fields = [f"""coalesce('"{c}":"' || "{c}" || '",', '{f'"{c}":null,' if nulls else ''}')""" for c in _TEXTS]
    return "'{' || " + " || ".join(fields) + f""" || '"amount":' || {last} || '}}'"""


_WHOLE_SQL = _message_sql(True, "coalesce(CAST(amount AS VARCHAR), 'null')")
_FAULTS = f"""WITH {_STD.replace("  FROM events", "         , event_id\n  FROM events")},
message AS (
  SELECT *, CASE event_id % 6 WHEN 0 THEN 'garbage' WHEN 1 THEN NULL WHEN 2 THEN '{{"user_id":"b"'
         WHEN 3 THEN {_message_sql(False, "'\"x\"'")}
         WHEN 4 THEN '{{"extra":1,' || substr({_WHOLE_SQL}, 2) ELSE {_WHOLE_SQL} END AS value
  FROM std),
judged AS (
  SELECT value, CASE WHEN event_id % 6 = 1 THEN 'no message' WHEN event_id % 6 IN (0, 2) THEN 'malformed'
         WHEN user_id IS NULL THEN 'missing field'
         WHEN event_type NOT IN ('page_view', 'search', 'add_to_cart', 'purchase', 'logout')
         THEN 'unknown type' WHEN event_id % 6 = 3 THEN 'mistyped field' END AS fault
  FROM message)
SELECT value, fault, fault <> 'mistyped field' AS dropped FROM judged WHERE fault IS NOT NULL"""
_FILTERED = "event_type = 'purchase' AND country = 'US'"
