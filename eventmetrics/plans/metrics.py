"""Metric queries over the serving table.

Each takes the aggregates and returns a lazy DataFrame. `as_of` is the "now" that look-backs
count from; it defaults to the time the query runs. Where rows tie, the key columns in
ascending order decide, so results are repeatable.

Unique users of a metric are the sum of its groups' distinct users. Somebody active in
several windows or countries counts once in each. `distinct_users` counts them once, from the
sketches of a stored table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from eventmetrics.functions import (
    ALL,
    bucket_for,
    clock_label,
    compact_number,
    lookback,
    match_or_all,
    or_zero,
    time_bucket,
)
from eventmetrics.functions.filters import DEFAULT_TIME_WINDOW, AsOf
from eventmetrics.schema import PURCHASE, USER_SKETCH

TOP_COUNTRIES = 10
LIVE_FEED_ROWS = 20


def _selected(aggregates: DataFrame, time_window: str, as_of: AsOf,
              event_type: str = ALL, country: str = ALL) -> DataFrame:
    rows = lookback(aggregates, time_window, as_of)
    return match_or_all(match_or_all(rows, "event_type", event_type), "country", country)


def _events(name: str = "event_count") -> Column:
    return F.sum("event_count").cast("bigint").alias(name)


def _users() -> Column:
    return F.sum("unique_users").cast("bigint").alias("unique_users")


def _revenue(name: str = "revenue") -> Column:
    return or_zero(F.sum("total_revenue")).alias(name)


def _options(aggregates: DataFrame, column: str) -> DataFrame:
    values = aggregates.select(column).distinct().withColumn("rank", F.lit(1))
    # One generated row, so there is no driver-side data to ship.
    head = aggregates.sparkSession.range(0, 1, 1, 1).select(
        F.lit(ALL).alias(column), F.lit(0).alias("rank"))
    return (head.unionByName(values)
            .orderBy("rank", F.asc_nulls_last(column)).select(column))


def filter_event_types(aggregates: DataFrame) -> DataFrame:
    """'All', then the event types in order."""
    return _options(aggregates, "event_type")


def filter_countries(aggregates: DataFrame) -> DataFrame:
    """'All', then the countries in order, a NULL last."""
    return _options(aggregates, "country")


def kpi_summary(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                event_type: str = ALL, country: str = ALL, as_of: AsOf = None) -> DataFrame:
    """Always one row: total events, users and revenue, and the number of active countries."""
    return _selected(aggregates, time_window, as_of, event_type, country).agg(
        or_zero(F.sum("event_count")).cast("bigint").alias("total_events"),
        or_zero(F.sum("unique_users")).cast("bigint").alias("total_unique_users"),
        _revenue("total_revenue"),
        F.count_distinct(F.col("country")).cast("int").alias("active_countries"),
    )


def distinct_users(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                   event_type: str = ALL, country: str = ALL, as_of: AsOf = None,
                   by: str | None = None) -> DataFrame:
    """Users over all windows, each counted once, to about 1.6 percent; per value of `by` if given.

    Needs the column user_sketch, which stored tables have. Sketches of all windows are merged,
    first within each task, so one of fixed size for each group and task is shuffled.
    """
    rows = _selected(aggregates, time_window, as_of, event_type, country)
    users = F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(USER_SKETCH)), F.lit(0)).cast("bigint")
    merged = (rows.groupBy(by) if by else rows).agg(users.alias("distinct_users"))
    return merged.orderBy(F.desc("distinct_users"), F.asc_nulls_last(by)) if by else merged


def kpi_cards(kpis: DataFrame) -> DataFrame:
    """The KPI row as short texts; dashes throughout when there were no events."""
    def card(column: str, prefix: str = "") -> Column:
        shown = F.when(F.col("total_events") > 0, F.col(column))
        return compact_number(shown, prefix).alias(column)

    return kpis.select(card("total_events"), card("total_unique_users"),
                       card("total_revenue", "$"), card("active_countries"))


def events_over_time(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                     event_type: str = ALL, country: str = ALL,
                     as_of: AsOf = None) -> DataFrame:
    """Events, users and revenue per bucket, whose width follows the look-back."""
    rows = _selected(aggregates, time_window, as_of, event_type, country)
    return (rows.withColumn("bucket", time_bucket("window_start", bucket_for(time_window)))
            .groupBy("bucket").agg(_events(), _users(), _revenue()).orderBy("bucket"))


def event_type_distribution(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                            country: str = ALL, as_of: AsOf = None) -> DataFrame:
    """Events, users and revenue per event type, most events first."""
    return (_per_event_type(aggregates, time_window, country, as_of)
            .orderBy(F.desc("event_count"), "event_type"))


def _per_event_type(aggregates: DataFrame, time_window: str, country: str,
                    as_of: AsOf) -> DataFrame:
    return (_selected(aggregates, time_window, as_of, country=country)
            .groupBy("event_type").agg(_events(), _users(), _revenue()))


def event_type_share(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                     country: str = ALL, as_of: AsOf = None) -> DataFrame:
    """Each event type's percentage of all events, with the grand total."""
    # The window sees one row per event type, never the aggregates themselves.
    total = F.sum("event_count").over(W.partitionBy())
    return (_per_event_type(aggregates, time_window, country, as_of)
            .select("event_type", "event_count", total.alias("total_events"))
            .withColumn("percent", 100.0 * F.col("event_count") / F.col("total_events"))
            .orderBy(F.desc("event_count"), "event_type"))


def revenue_by_event_type(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                          country: str = ALL, as_of: AsOf = None) -> DataFrame:
    """The distribution's rows that have revenue."""
    return event_type_distribution(aggregates, time_window, country, as_of).filter("revenue > 0")


def top_countries(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                  event_type: str = ALL, n: int = TOP_COUNTRIES,
                  as_of: AsOf = None) -> DataFrame:
    """The n countries with most events, with their revenue."""
    return (_selected(aggregates, time_window, as_of, event_type)
            .groupBy("country").agg(_events(), _revenue())
            .orderBy(F.desc("event_count"), F.asc_nulls_last("country")).limit(n))


def top_countries_ascending(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                            event_type: str = ALL, n: int = TOP_COUNTRIES,
                            as_of: AsOf = None) -> DataFrame:
    """The same n countries, fewest events first."""
    return (top_countries(aggregates, time_window, event_type, n, as_of)
            .orderBy("event_count", F.asc_nulls_last("country")))


def purchase_trends(aggregates: DataFrame, time_window: str = DEFAULT_TIME_WINDOW,
                    country: str = ALL, as_of: AsOf = None) -> DataFrame:
    """Revenue and number of purchases per hour."""
    return (_selected(aggregates, time_window, as_of, PURCHASE, country)
            .groupBy(F.date_trunc("hour", "window_start").alias("hour"))
            .agg(_revenue(), _events("purchases")).orderBy("hour"))


def live_feed(aggregates: DataFrame, limit: int = LIVE_FEED_ROWS,
              with_label: bool = False) -> DataFrame:
    """The newest aggregates, whatever their age, with an optional time-of-day label."""
    newest = (aggregates
              .select("window_start", "event_type", "country", "event_count", "unique_users",
                      or_zero(F.col("total_revenue")).alias("total_revenue"))
              .orderBy(F.desc_nulls_first("window_start"), F.asc_nulls_last("event_type"),
                       F.asc_nulls_last("country"))
              .limit(limit))
    return newest.withColumn("label", clock_label("window_start")) if with_label else newest
