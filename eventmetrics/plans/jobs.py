"""Whole jobs: a source to the event lake and the serving table, bounded or continuous."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eventmetrics.operators import (
    clean_events,
    enrich_events,
    window_aggregations,
    with_fault,
)
from eventmetrics.schema import EVENT_SCHEMA, WINDOW_DURATION
from eventmetrics.session import file_system
from eventmetrics.sources import (
    decode_events,
    decode_messages,
    read_aggregate_log,
    read_aggregates,
    read_event_lake,
    read_late_events,
)
from eventmetrics.sources.aggregates import Target
from eventmetrics.sources.snapshots import current
from eventmetrics.streaming import (
    in_folders,
    latest_aggregates,
    newest_batches,
    replace_aggregates,
    replace_dates,
    with_late_events,
    write_aggregate_log,
    write_event_lake,
    write_outputs,
)
from eventmetrics.streaming.sinks import EVERY_30_SECONDS

POLL_SECONDS = 5


def prepare_events(source: DataFrame) -> DataFrame:
    """Source rows, messages with a `value` or plain event columns, to enriched events."""
    events = decode_events(source) if "value" in source.columns else source
    return enrich_events(clean_events(events))


def judge_messages(source: DataFrame) -> DataFrame:
    """Source rows to `value`, the event columns and `fault`; events without a message get one."""
    if "value" in source.columns:
        return with_fault(decode_messages(source))
    message = F.to_json(F.struct(*EVENT_SCHEMA.fieldNames()), {"ignoreNullFields": "false"})
    return with_fault(source.select(
        message.alias("value"), *EVENT_SCHEMA.fieldNames(), F.lit(False).alias("corrupt")))


def run_batch(spark: SparkSession, source: DataFrame, out: str,
              duration: str = WINDOW_DURATION) -> DataFrame:
    """Rebuild `out`/events and `out`/aggregates from a bounded source; returns the latter.

    The source is decoded once. The aggregates read the five columns they need back from the
    lake. To add only what is new, use `run_stream` with the trigger `availableNow`, and a folder
    of its own: a stream keeps a list of the lake's files, which a rebuild would not, so its
    folder is refused here.
    """
    if any(_exists(spark, f"{out}/{name}") for name in ("events/_spark_metadata", "checkpoints")):
        raise ValueError(f"{out}/events belongs to a stream; rebuild into another folder")
    write_event_lake(prepare_events(source), f"{out}/events", mode="overwrite")
    aggregates = window_aggregations(read_event_lake(spark, f"{out}/events"), duration, "users",
                                     sketch=True)
    return replace_aggregates(aggregates, f"{out}/aggregates")


def run_stream(spark: SparkSession, source: DataFrame, out: str,
               duration: str = WINDOW_DURATION, distinct: str = "users",
               watermark: str | None = None,
               trigger: Mapping | None = None, wait: bool = True) -> list[StreamingQuery]:
    """Stream a source into `out`/events and `out`/aggregate_log.

    With the method `users` one query writes both, `out`/faults and `out`/progress, from messages that
    are read and decoded once; with a `watermark` it puts events of closed windows into
    `out`/late_events (see `write_outputs`). The other methods keep state, which only a query of its own can: then two
    queries progress on their own, without `out`/faults. An output that two queries began is
    continued by two. Checkpoints are under `out`/checkpoints.

    With `wait`, a bounded trigger (availableNow, once) returns when all is done, and a
    continuous one when a query stops. If one fails, the other is stopped and the error raised.

    With `two_level`, `update` or `approx`, `spark.sql.shuffle.partitions` of the first start is kept in the
    checkpoint: set it to the size the state will need before then.
    """
    trigger = trigger or EVERY_30_SECONDS
    if distinct == "users" and not _exists(spark, f"{out}/checkpoints/events"):
        query = write_outputs(judge_messages(source), out, duration, trigger, watermark)
        if wait:
            query.awaitTermination()  # raises the error it failed with
        return [query]
    events = prepare_events(source)
    aggregates = window_aggregations(events, duration, distinct, watermark)
    output_mode = "append" if distinct == "two_level" else "update"
    queries = []
    try:
        queries.append(write_event_lake(
            events, f"{out}/events", f"{out}/checkpoints/events", trigger))
        queries.append(write_aggregate_log(
            aggregates, f"{out}/aggregate_log", f"{out}/checkpoints/aggregate_log", trigger,
            output_mode))
        if wait:
            _await(queries, bounded="availableNow" in trigger or "once" in trigger)
    except BaseException:
        _stop(queries)
        raise
    if wait:
        _stop(queries)
    return queries


def refresh_aggregates(spark: SparkSession, out: str, target: Target | None = None,
                       log_path: str | None = None,
                       late_windows: str | None = None) -> DataFrame:
    """Bring a serving table up to date with `out`/aggregate_log (or `log_path`) and return it.

    The table is `out`/aggregates, or a database table, which is loaded anew. The former notes for
    each date the newest batch that it has taken; only dates of which the log has another one are
    computed, and all of them are replaced in one step. So it does not matter whether the log was
    compacted in between, and a refresh that fails half-way is simply run again. Between refreshes,
    `latest_aggregates(read_aggregate_log(...))` answers the same queries from the log itself;
    look-backs reach its scan too.

    With `late_windows`, the duration of the log's windows, the events of `out`/late_events count as
    well. Keep to one choice for a table.
    """
    log = read_aggregate_log(spark, log_path or f"{out}/aggregate_log")
    if late_windows:
        log = with_late_events(log, read_late_events(spark, f"{out}/late_events"), late_windows)
    if target:
        return replace_aggregates(latest_aggregates(log), target)
    table = f"{out}/aggregates"
    newest, held = newest_batches(log), current(spark, table)
    if held is None:
        return replace_aggregates(latest_aggregates(log, sketch=True), table, newest)
    changed = [folder for folder, batch in newest.items()
               if folder not in held or held[folder][1] != batch]
    gone = set(held) - set(newest)
    if changed or gone:
        rows = latest_aggregates(in_folders(log, changed), sketch=True)
        replace_dates(rows, table, newest, gone)
    return read_aggregates(spark, table)


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)


def _await(queries: list[StreamingQuery], bounded: bool) -> None:
    # Each query is asked itself: the session's own wait would also end with anybody else's.
    if not bounded:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(POLL_SECONDS)
    for query in queries:
        if bounded or not query.isActive:
            query.awaitTermination()  # raises the error it failed with


def _stop(queries: list[StreamingQuery]) -> None:
    for query in queries:
        if query.isActive:
            query.stop()
