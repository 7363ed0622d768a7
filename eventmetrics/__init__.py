"""Clickstream analytics on Spark: events to an event lake, window aggregates and metrics."""

from eventmetrics.operators import (
    clean_events,
    enrich_events,
    faulty_messages,
    purchase_events,
    user_windows,
    window_aggregations,
    with_event_time,
    with_fault,
)
from eventmetrics.plans import (
    assert_quality,
    check_amounts,
    check_freshness,
    check_nulls,
    check_row_count,
    judge_messages,
    metrics,
    prepare_events,
    quality_report,
    report_of_statistics,
    refresh_aggregates,
    run_batch,
    run_stream,
)
from eventmetrics.schema import (
    AGGREGATE_LOG_SCHEMA,
    AGGREGATE_SCHEMA,
    EVENT_SCHEMA,
    EVENT_TYPES,
    SERVING_SCHEMA,
)
from eventmetrics.session import build_session
from eventmetrics.sources import (
    decode_events,
    decode_messages,
    encode_events,
    expire_snapshots,
    gather_statistics,
    peek_events,
    read_aggregate_log,
    read_aggregates,
    read_event_lake,
    read_event_stream,
    read_events,
    read_faults,
    read_late_events,
    read_progress,
    read_statistics,
    write_events,
)
from eventmetrics.streaming import (
    compact_aggregate_log,
    latest_aggregates,
    open_windows,
    replace_aggregates,
    windows_so_far,
    with_late_events,
    write_aggregate_log,
    write_aggregates_jdbc,
    write_event_lake,
    write_outputs,
)

__all__ = [
    "AGGREGATE_LOG_SCHEMA",
    "AGGREGATE_SCHEMA",
    "EVENT_SCHEMA",
    "EVENT_TYPES",
    "SERVING_SCHEMA",
    "assert_quality",
    "build_session",
    "check_amounts",
    "check_freshness",
    "check_nulls",
    "check_row_count",
    "clean_events",
    "compact_aggregate_log",
    "decode_events",
    "decode_messages",
    "encode_events",
    "enrich_events",
    "expire_snapshots",
    "faulty_messages",
    "gather_statistics",
    "judge_messages",
    "latest_aggregates",
    "metrics",
    "open_windows",
    "peek_events",
    "prepare_events",
    "purchase_events",
    "quality_report",
    "read_aggregate_log",
    "read_aggregates",
    "read_event_lake",
    "read_event_stream",
    "read_events",
    "read_faults",
    "read_late_events",
    "read_progress",
    "read_statistics",
    "refresh_aggregates",
    "replace_aggregates",
    "report_of_statistics",
    "run_batch",
    "run_stream",
    "user_windows",
    "window_aggregations",
    "windows_so_far",
    "with_event_time",
    "with_fault",
    "with_late_events",
    "write_aggregate_log",
    "write_aggregates_jdbc",
    "write_event_lake",
    "write_events",
    "write_outputs",
]
