"""Tumbling-window aggregates with exact distinct users, in batch and in streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.operators.events import with_event_time
from eventmetrics.schema import AMOUNT, MONEY_SUM, USER_SKETCH, WINDOW_DURATION

METHODS = ("exact", "set", "users", "two_level", "update", "approx")
_STATEFUL = ("two_level", "update")  # these need a watermark, without which their state would grow

# Into how many parts the users of one group are split by the `set` method, in batch. A user
# falls into exactly one part, so the parts' distinct counts add up to the group's.
USER_BUCKETS = 32
# Sketches of users have 2 ** SKETCH_BITS buckets, and a standard error of 1.04 / 2 ** (SKETCH_BITS / 2).
SKETCH_BITS = 12


def window_aggregations(df: DataFrame, duration: str = WINDOW_DURATION,
                        distinct: str | None = None, watermark: str | None = None,
                        user_buckets: int = USER_BUCKETS, sketch: bool = False) -> DataFrame:
    """Events, distinct users and revenue per window, event type and country.

    Windows are epoch-aligned and half-open. A NULL country is a group of its own; events
    without a parsable time are in no window. Revenue is NULL if every amount is NULL; amounts are
    added up exactly, to the millionth, and the sum is rounded to cents.

    `distinct` is how users are counted:

    ``exact``      batch default. Spark's distinct aggregate: it first shuffles on the group
                   and the user, so that a hot group is spread over all tasks.
    ``users``      stream default. The stream keeps no state: its rows are the events with
                   their windows, `write_aggregate_log` adds up each micro-batch by group and
                   user, and `latest_aggregates` all of them. Late events always count. In
                   batch the same two steps are done here.
    ``set``        batch only. The users of each group in `user_buckets` separate sets.
    ``two_level``  streams in append mode with a watermark. One small state row per group
                   and user, however hot the group is. Events later than the watermark are
                   dropped, as the progress of the query reports. Rows come when a window has
                   closed; `open_windows` reads those that have not.
    ``update``     streams in update mode with a watermark. The same state row per group and
                   user, which expires with its window; each micro-batch gives the users' rows
                   that it changed, and `latest_aggregates` adds up the newest ones. So windows
                   are there before they close, and rows are states: a repeated one adds nothing.
                   In batch as ``two_level``.
    ``approx``     HyperLogLog++ sketch. Constant state, inexact, opt-in.

    With `sketch` (``users``, ``two_level`` and ``update``, in batch) there is a column user_sketch as well, which
    `metrics.distinct_users` merges: the sum of unique_users counts somebody once in each window.
    """
    if distinct is None:
        distinct = "users" if df.isStreaming else "exact"
    if distinct not in METHODS:
        raise ValueError(f"distinct must be one of {METHODS}, not {distinct!r}")
    if df.isStreaming and distinct in ("exact", "set"):
        raise ValueError(f"a stream cannot use distinct={distinct!r}; use 'users' or 'two_level'")
    if df.isStreaming and distinct in _STATEFUL and not watermark:
        raise ValueError(f"distinct={distinct!r} on a stream needs a watermark")
    if user_buckets < 1:
        raise ValueError("user_buckets must be at least 1")

    if sketch and (distinct not in ("users", *_STATEFUL) or df.isStreaming):
        raise ValueError("sketches need distinct='users', 'two_level' or 'update' in batch")
    if df.isStreaming and distinct == "users":
        return user_windows(df, duration, watermark)
    df = _prepared(df, watermark)
    window = F.window("event_time", duration)
    if df.isStreaming:
        # The watermark travels with the struct column, so it stays whole until the end.
        by = [window.alias("window"), F.col("event_type"), F.col("country")]
    else:
        # A flat long key makes hash aggregation and shuffled rows smaller than a struct does.
        df = df.withColumn("window_start", window.getField("start"))
        by = [F.col("window_start"), F.col("event_type"), F.col("country")]

    if df.isStreaming and distinct == "update":
        return _user_states(df, by)
    if distinct in ("users", "two_level", "update"):
        grouped = _two_level(df, by, sketch)
    elif distinct == "set":
        grouped = _bucketed_sets(df, by, user_buckets)
    else:
        count = F.count_distinct if distinct == "exact" else F.approx_count_distinct
        grouped = df.groupBy(*by).agg(*_measures(count(F.col("user_id"))))
    return _flatten(grouped, duration)


def _prepared(df: DataFrame, watermark: str | None) -> DataFrame:
    if "event_time" not in df.columns:
        df = with_event_time(df)
    if watermark and df.isStreaming:
        df = df.withWatermark("event_time", watermark)
    return df.withColumn("amount", F.col("amount").cast("double").try_cast(AMOUNT))


def user_windows(df: DataFrame, duration: str = WINDOW_DURATION,
                 watermark: str | None = None, more: tuple[str, ...] = ()) -> DataFrame:
    """Each event's window, group, user and amount: the rows that the aggregate log adds up.

    With `more`, other columns of the events as well.
    """
    return _prepared(df, watermark).withColumn("window", F.window("event_time", duration)).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "event_type", "country", "user_id", "amount", *more)


def late_events(df: DataFrame, mark: Column, duration: str = WINDOW_DURATION) -> DataFrame:
    """The events whose window had ended by `mark`."""
    window = F.window("event_time", duration)
    return (df.withColumn("window", window).filter(F.col("window.end") <= mark).drop("window"))


def to_cents(amount: Column) -> Column:
    """An exact sum, rounded (half up) to cents."""
    return F.round(amount, 2).cast(MONEY_SUM)


def _measures(unique_users: Column) -> list[Column]:
    return [
        F.count("*").alias("event_count"),
        unique_users.alias("unique_users"),
        F.sum("amount").alias("amount"),
    ]


def _names(by: list[Column], df: DataFrame) -> list[str]:
    return df.columns[:len(by)]


def sketch_users(user: str = "user_id") -> Column:
    """A sketch of the distinct users of a group; NULL users are not counted."""
    return F.hll_sketch_agg(user, F.lit(SKETCH_BITS)).alias(USER_SKETCH)


def _per_user(df: DataFrame, by: list[Column]) -> DataFrame:
    return df.groupBy(*by, "user_id").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"))


def _user_states(df: DataFrame, by: list[Column]) -> DataFrame:
    """Each user's part of a group so far, in the columns of the log; not rounded."""
    return _per_user(df, by).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
        "event_type", "country", "user_id", F.col("n").alias("event_count"),
        F.col("user_id").isNotNull().cast("long").alias("unique_users"),
        F.col("amount").alias("total_revenue"))


def _two_level(df: DataFrame, by: list[Column], sketch: bool) -> DataFrame:
    per_user = _per_user(df, by)
    return per_user.groupBy(*_names(by, per_user)).agg(
        F.sum("n").alias("event_count"),
        F.count("user_id").alias("unique_users"),
        F.sum("amount").alias("amount"),
        *([sketch_users()] if sketch else []),
    )


def _bucketed_sets(df: DataFrame, by: list[Column], buckets: int) -> DataFrame:
    # A hash of the row, never a random number: a retried task has to rebuild the same rows.
    bucket = F.pmod(F.xxhash64("user_id"), F.lit(buckets)).alias("user_bucket")
    parts = df.groupBy(*by, bucket).agg(*_measures(F.size(F.collect_set("user_id")).cast("long")))
    return parts.groupBy(*_names(by, parts)).agg(*[
        F.sum(name).alias(name) for name in ("event_count", "unique_users", "amount")])


def _flatten(grouped: DataFrame, duration: str) -> DataFrame:
    if "window" in grouped.columns:
        start, end = F.col("window.start"), F.col("window.end")
    else:
        # The window that begins there, so that a day with a change of clocks ends as in a stream.
        start = F.col("window_start")
        end = F.window(start, duration).getField("end")
    return grouped.withColumn("window_end", end).select(
        start.alias("window_start"), "window_end", "event_type", "country",
        "event_count", "unique_users", to_cents(F.col("amount")).alias("total_revenue"),
        *[c for c in grouped.columns if c == USER_SKETCH],
    )
