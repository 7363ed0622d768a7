"""Filters that metric queries share, kept as plain comparisons so that scans can use them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.schema import WINDOW_DATE

# The labels users choose from, how far each looks back, and the bucket that
# keeps its time series readable. Any other label looks back 24 hours in 6-hour buckets.
LOOKBACKS = {
    "Last 1 Hour": "1 hour",
    "Last 6 Hours": "6 hours",
    "Last 24 Hours": "24 hours",
    "Last 7 Days": "7 days",
    "Last 30 Days": "30 days",
}
DEFAULT_LOOKBACK = "24 hours"
BUCKETS = {
    "Last 1 Hour": "10 minutes",
    "Last 6 Hours": "30 minutes",
    "Last 24 Hours": "1 hour",
    "Last 7 Days": "1 hour",
}
DEFAULT_BUCKET = "6 hours"
DEFAULT_TIME_WINDOW = "Last 24 Hours"
ALL = "All"

AsOf = str | datetime | None


def instant(as_of: AsOf) -> Column:
    """A fixed time, or the time at which the query runs.

    A time without a zone is in the session's zone. Spark would take a Python object as being
    in the zone of the driver's machine, so it goes in as text.
    """
    if as_of is None:
        return F.current_timestamp()
    text = as_of.isoformat() if isinstance(as_of, datetime) else as_of
    return F.lit(text).cast("timestamp")


def lookback(df: DataFrame, time_window: str = DEFAULT_TIME_WINDOW, as_of: AsOf = None,
             column: str = "window_start") -> DataFrame:
    """Rows whose `column` is at most the labelled time before `as_of` (inclusive).

    The bound takes the column's own type. It then folds to a constant, and the column is
    compared uncast, which is what lets Parquet and databases skip data. A frame with the dates of
    its windows is filtered by them too, which skips folders.
    """
    length = LOOKBACKS.get(time_window, DEFAULT_LOOKBACK)
    earliest = instant(as_of) - F.expr(f"INTERVAL {length}")
    if column == "window_start" and WINDOW_DATE in df.columns:
        df = df.filter(F.col(WINDOW_DATE) >= earliest.cast("date"))
    return df.filter(F.col(column) >= earliest.cast(df.schema[column].dataType))


def match_or_all(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows where `column` equals `value`; every row, also NULLs, for 'All'."""
    return df if value == ALL else df.filter(F.col(column) == F.lit(value))


def bucket_for(time_window: str) -> str:
    """Width of a time-series bucket for a look-back label."""
    return BUCKETS.get(time_window, DEFAULT_BUCKET)
