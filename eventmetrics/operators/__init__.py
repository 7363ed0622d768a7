from eventmetrics.operators.events import (
    clean_events,
    enrich_events,
    faulty_messages,
    purchase_events,
    with_event_time,
    with_fault,
)
from eventmetrics.operators.windows import user_windows, window_aggregations

__all__ = [
    "clean_events",
    "enrich_events",
    "faulty_messages",
    "purchase_events",
    "user_windows",
    "window_aggregations",
    "with_event_time",
    "with_fault",
]
