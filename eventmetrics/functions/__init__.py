from eventmetrics.functions.columns import (
    as_results,
    clock_label,
    compact_number,
    or_zero,
    time_bucket,
)
from eventmetrics.functions.filters import ALL, LOOKBACKS, bucket_for, lookback, match_or_all

__all__ = [
    "ALL",
    "LOOKBACKS",
    "as_results",
    "bucket_for",
    "clock_label",
    "compact_number",
    "lookback",
    "match_or_all",
    "or_zero",
    "time_bucket",
]
