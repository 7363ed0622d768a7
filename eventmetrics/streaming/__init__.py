from eventmetrics.streaming.sinks import (
    compact_aggregate_log,
    in_folders,
    latest_aggregates,
    newest_batches,
    replace_aggregates,
    replace_dates,
    with_late_events,
    write_aggregate_log,
    write_aggregates_jdbc,
    write_event_lake,
    write_outputs,
)
from eventmetrics.streaming.state import open_windows, state_batch, windows_so_far

__all__ = [
    "compact_aggregate_log",
    "in_folders",
    "latest_aggregates",
    "newest_batches",
    "open_windows",
    "replace_aggregates",
    "replace_dates",
    "state_batch",
    "windows_so_far",
    "with_late_events",
    "write_aggregate_log",
    "write_aggregates_jdbc",
    "write_event_lake",
    "write_outputs",
]
