"""Window aggregates in batch: every way of counting users, and awkward groups."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventmetrics import (
    EVENT_TYPES,
    check_amounts,
    clean_events,
    metrics,
    window_aggregations,
    with_event_time,
)
from tests.conftest import rows_of

EXACT = ["exact", "set", "users", "two_level"]


def by_key(df):
    return {(r["window_start"].strftime("%H:%M"), r["event_type"], r["country"]): r
            for r in df.collect()}


@pytest.mark.parametrize("distinct", EXACT)
def test_windows_are_half_open_and_flat(events, distinct):
    df = window_aggregations(events({"timestamp": "2026-01-15T11:04:59"},
                                    {"timestamp": "2026-01-15T11:05:00"}), distinct=distinct)
    assert df.columns == ["window_start", "window_end", "event_type", "country", "event_count",
                          "unique_users", "total_revenue"]
    rows = df.orderBy("window_start").collect()
    assert [r["window_start"].minute for r in rows] == [0, 5]
    assert all(r["window_end"] - r["window_start"] == timedelta(minutes=5) for r in rows)


@pytest.mark.parametrize("distinct", EXACT)
def test_a_repeated_user_counts_once(events, distinct):
    row = window_aggregations(events({}, {}, {"user_id": "u2"}), distinct=distinct).first()
    assert (row["event_count"], row["unique_users"]) == (3, 2)


@pytest.mark.parametrize("distinct", EXACT)
def test_null_country_is_a_group_and_null_users_are_not_counted(events, distinct):
    groups = by_key(window_aggregations(
        events({"country": None}, {"country": None, "user_id": None}, {}), distinct=distinct))
    assert len(groups) == 2
    nobody = groups["11:00", "page_view", None]
    assert (nobody["event_count"], nobody["unique_users"]) == (2, 1)


@pytest.mark.parametrize("distinct", EXACT)
def test_revenue_of_no_amounts_is_null(events, distinct):
    groups = by_key(window_aggregations(
        events({}, {}, {"country": "DE", "amount": 0.1}, {"country": "DE", "amount": 0.2}),
        distinct=distinct))
    assert groups["11:00", "page_view", "US"]["total_revenue"] is None
    assert groups["11:00", "page_view", "DE"]["total_revenue"] == Decimal("0.30")


@pytest.mark.parametrize("distinct", EXACT)
def test_amounts_of_any_size_are_added_up_and_rounded_once(events, distinct):
    def revenue(*amounts):
        rows = [{"amount": amount} for amount in amounts]
        return window_aggregations(events(*rows), distinct=distinct).first()["total_revenue"]

    assert revenue(2e10, 1.0) == Decimal("20000000001.00")
    assert revenue(1e20, 0.01) == Decimal("100000000000000000000.01")
    assert revenue(1.005) == Decimal("1.01") and revenue(0.125) == Decimal("0.13")
    assert revenue(0.004, 0.004, 0.004) == Decimal("0.01")
    assert revenue(0.1, 0.2, -0.3) == Decimal("0.00")


def test_amounts_that_are_no_numbers_are_missing_and_a_check_counts_them(events):
    df = events({"amount": float("nan")}, {"amount": float("-inf")}, {"amount": -0.29},
                {"amount": None})
    row = window_aggregations(df).first()
    assert (row["event_count"], row["total_revenue"]) == (4, Decimal("-0.29"))
    check = check_amounts(df).first()
    assert (check["check"], check["observed"], check["status"]) == ("amounts", 2, "failed")


def test_a_day_of_23_hours_ends_with_the_day(spark, events):
    zone = "spark.sql.session.timeZone"
    before = spark.conf.get(zone)
    spark.conf.set(zone, "America/New_York")
    try:
        df = with_event_time(events({"timestamp": "2024-03-10T12:00:00"}))
        window = F.window("event_time", "1 day")
        expected = df.select(window.start.cast("string"), window.end.cast("string")).first()
        got = window_aggregations(df, "1 day").select(
            F.col("window_start").cast("string"), F.col("window_end").cast("string")).first()
        assert tuple(got) == tuple(expected)
    finally:
        spark.conf.set(zone, before)


def test_every_amount_of_two_decimals_is_exact(spark, events):
    amounts = spark.range(0, 2_000_000, 7).selectExpr("id", "id / 100.0D AS amount")
    df = events({}).drop("amount").join(amounts)
    row = window_aggregations(df).select("total_revenue").first()
    assert row[0] == Decimal(sum(range(0, 2_000_000, 7))) / 100


def test_unparsable_times_are_in_no_window(events):
    assert window_aggregations(events({"timestamp": "garbage"}, {})).count() == 1


def by_hand(rows):
    """Five-minute groups of raw events, worked out one event at a time."""
    groups = {}
    for r in rows:
        if None in (r["user_id"], r["event_type"], r["timestamp"]):
            continue
        if r["event_type"] not in EVENT_TYPES or r["timestamp"] == "garbage":
            continue
        time = datetime.fromisoformat(r["timestamp"])
        start = time.replace(minute=time.minute // 5 * 5, second=0)
        n, users, amounts = groups.setdefault(
            (start, r["event_type"], r["country"]), ([], set(), []))
        n.append(1)
        users.add(r["user_id"])
        if r["amount"] is not None:
            amounts.append(Decimal(str(r["amount"])))
    return {key: (len(n), len(users), sum(amounts) if amounts else None)
            for key, (n, users, amounts) in groups.items()}


@pytest.mark.parametrize("distinct", EXACT)
def test_random_events_equal_the_count_by_hand(events, distinct):
    pick = random.Random(7).choice
    rows = [{
        "user_id": pick([None, "", "a", "b", "c", "d"]),
        "event_type": pick([None, "unknown", "Purchase", *EVENT_TYPES]),
        "timestamp": pick([None, "garbage", *(f"2026-01-15T{h}:{m:02d}:{s}" for h in (10, 23)
                                              for m in (4, 5, 59) for s in ("00", "59"))]),
        "country": pick([None, "", "US", "DE"]),
        "amount": pick([None, None, 0.0, 0.1, 19.99, -5.25, 499.5]),
    } for _ in range(2000)]
    result = window_aggregations(clean_events(events(*rows)), distinct=distinct)
    got = {(r["window_start"], r["event_type"], r["country"]):
           (r["event_count"], r["unique_users"], r["total_revenue"]) for r in result.collect()}
    assert got == by_hand(rows)
    assert len(got) > 100


@pytest.mark.parametrize("duration", ["5 minutes", "6 hours", "1 day"])
def test_exact_ways_agree(std, duration):
    results = [rows_of(window_aggregations(clean_events(std), duration, distinct=d))
               for d in EXACT]
    assert results[0] == results[1] == results[2]


def test_types_do_not_depend_on_how_users_are_counted(std):
    schemas = {window_aggregations(std, distinct=d).schema.simpleString()
               for d in [*EXACT, "approx"]}
    assert len(schemas) == 1


def test_bucket_count_does_not_change_the_result(std):
    few, many = (rows_of(window_aggregations(std, "1 day", "set", user_buckets=n))
                 for n in (1, 1000))
    assert few == many


def hot_events(spark, n=60_000):
    """A third of all rows in one group, half of those by one user, the rest by many."""
    start = datetime(2026, 1, 15)
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.when(hot & (F.col("id") % 2 == 0), F.lit("bot"))
        .otherwise(F.concat(F.lit("u"), F.col("id"))).alias("user_id"),
        F.lit("page_view").alias("event_type"),
        F.date_format(
            F.lit(start) + F.when(hot, F.lit(0)).otherwise(F.col("id") % 288 * 5)
            * F.expr("INTERVAL 1 MINUTE"), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(None).cast("string").alias("session_id"),
        F.lit("mobile").alias("device"), F.lit("/").alias("page"),
        F.when(hot, F.lit("US")).otherwise(F.lit("DE")).alias("country"),
        F.lit(1.0).alias("amount"))


@pytest.mark.parametrize("distinct", EXACT)
def test_a_hot_group_is_counted_whole(spark, distinct):
    groups = by_key(window_aggregations(hot_events(spark), distinct=distinct))
    hot = groups["00:00", "page_view", "US"]
    assert hot["event_count"] == 20_000
    assert hot["unique_users"] == 10_001
    assert hot["total_revenue"] == Decimal("20000.00")
    assert sum(r["event_count"] for r in groups.values()) == 60_000


def test_a_hot_group_is_spread_over_tasks_before_it_is_counted(spark):
    plan = window_aggregations(hot_events(spark))._jdf.queryExecution().executedPlan().toString()
    first = [line for line in plan.splitlines() if "hashpartitioning" in line][-1]
    assert "user_id" in first
    assert "partial_count" in plan.splitlines()[plan.splitlines().index(first) + 1]


def test_approximate_counts_are_close(spark):
    hot = by_key(window_aggregations(hot_events(spark), distinct="approx"))[
        "00:00", "page_view", "US"]
    assert abs(hot["unique_users"] - 10_001) < 1_500


def test_bad_arguments(std):
    with pytest.raises(ValueError, match="distinct"):
        window_aggregations(std, distinct="no")
    with pytest.raises(ValueError, match="user_buckets"):
        window_aggregations(std, distinct="set", user_buckets=0)


def test_sketches_count_a_user_once_over_all_windows(spark, events):
    rows = events(*[{"user_id": f"u{i % 700}", "timestamp": f"2026-01-{1 + i % 20:02d}T00:00:00",
                     "country": ("US", "DE", None)[i % 3]} for i in range(4000)], {"user_id": None})
    table = window_aggregations(rows, "1 day", "users", sketch=True)
    assert table.columns[-1] == "user_sketch"
    plain = window_aggregations(rows, "1 day", "users")
    assert sorted(map(str, table.drop("user_sketch").collect())) == sorted(map(str, plain.collect()))
    assert plain.agg(F.sum("unique_users")).first()[0] > 2000
    whole = metrics.distinct_users(table, "Last 30 Days", as_of="2026-01-21").first()[0]
    assert abs(whole - 700) <= 5 * 0.01625 * 700
    by = metrics.distinct_users(table, "Last 30 Days", as_of="2026-01-21", by="country").collect()
    assert {r["country"] for r in by} == {"US", "DE", None}
    assert all(abs(r["distinct_users"] - 700) <= 5 * 0.01625 * 700 for r in by)
    none = metrics.distinct_users(table, "Last 30 Days", country="FR", as_of="2026-01-21")
    assert none.first()[0] == 0
    with pytest.raises(ValueError, match="sketches"):
        window_aggregations(rows, sketch=True)
