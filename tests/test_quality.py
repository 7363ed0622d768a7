"""Quality checks: each verdict, and their order."""

from datetime import datetime, timedelta

import pytest

from eventmetrics import (
    assert_quality,
    check_freshness,
    check_nulls,
    check_row_count,
    quality_report,
)
from eventmetrics.schema import AGGREGATE_SCHEMA

NOW = datetime(2026, 1, 15, 12)
FRESH = NOW - timedelta(hours=1)


@pytest.fixture()
def table(spark):
    def make(*rows):
        """(window_start, event_type, created_at)"""
        return spark.createDataFrame(
            [(start, None, kind, "US", 1, 1, None, created) for start, kind, created in rows],
            AGGREGATE_SCHEMA)
    return make


def verdicts(report):
    return {r["check"]: (r["observed"], r["status"]) for r in report.collect()}


def test_a_good_table_passes(table):
    good = table((FRESH, "search", FRESH))
    assert verdicts(quality_report(good, as_of=NOW, freshness=True)) == {
        "row_count": (1, "passed"), "freshness": (1, "passed"), "nulls": (0, "passed")}
    assert_quality(good, as_of=NOW, freshness=True)


def test_an_empty_table_fails_and_skips_the_rest(table):
    empty = table()
    assert verdicts(quality_report(empty, as_of=NOW, freshness=True)) == {
        "row_count": (0, "failed"), "freshness": (None, "skipped"), "nulls": (None, "skipped")}
    with pytest.raises(ValueError, match="row_count.*empty"):
        assert_quality(empty)


@pytest.mark.parametrize("row", [(None, "search", FRESH), (FRESH, None, FRESH)])
def test_a_null_fails(table, row):
    df = table(row, (FRESH, "search", FRESH))
    assert verdicts(check_nulls(df)) == {"nulls": (1, "failed")}
    with pytest.raises(ValueError, match="nulls.*observed 1"):
        assert_quality(df)


def test_a_row_with_two_nulls_counts_once(table):
    assert verdicts(check_nulls(table((None, None, FRESH)))) == {"nulls": (1, "failed")}


def test_columns_to_check_can_be_chosen(table):
    df = table((None, "search", FRESH))
    assert verdicts(check_nulls(df, ["event_type"])) == {"nulls": (0, "passed")}


def test_a_day_old_is_not_fresh(table):
    day_old = table((FRESH, "search", NOW - timedelta(days=1)))
    assert verdicts(check_freshness(day_old, NOW)) == {"freshness": (0, "failed")}
    younger = table((FRESH, "search", NOW - timedelta(days=1) + timedelta(seconds=1)))
    assert verdicts(check_freshness(younger, NOW)) == {"freshness": (1, "passed")}


def test_a_stale_table_skips_the_null_check(table):
    stale = table((None, "search", NOW - timedelta(days=2)))
    assert verdicts(quality_report(stale, as_of=NOW, freshness=True))["nulls"] == (
        None, "skipped")


def test_freshness_counts_from_now_by_default(table):
    assert verdicts(check_freshness(table((FRESH, "search", datetime(2000, 1, 1))))) == {
        "freshness": (0, "failed")}


def test_row_count(table):
    assert verdicts(check_row_count(table((FRESH, None, None)))) == {"row_count": (1, "passed")}


def test_all_checks_share_one_scan(table):
    plan = quality_report(table((FRESH, "search", FRESH)), freshness=True)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Scan ") == 1
