from eventmetrics.sources.aggregates import jdbc_options, read_aggregate_log, read_aggregates
from eventmetrics.sources.events import (
    decode_events,
    decode_messages,
    encode_events,
    peek_events,
    read_event_lake,
    read_event_stream,
    read_events,
    read_faults,
    read_late_events,
    read_progress,
    write_events,
)
from eventmetrics.sources.snapshots import expire_snapshots
from eventmetrics.sources.statistics import gather_statistics, read_statistics

__all__ = [
    "decode_events",
    "decode_messages",
    "encode_events",
    "expire_snapshots",
    "gather_statistics",
    "jdbc_options",
    "peek_events",
    "read_aggregate_log",
    "read_aggregates",
    "read_event_lake",
    "read_event_stream",
    "read_events",
    "read_faults",
    "read_late_events",
    "read_progress",
    "read_statistics",
    "write_events",
]
