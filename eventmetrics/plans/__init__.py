from eventmetrics.plans import metrics
from eventmetrics.plans.jobs import (
    judge_messages,
    prepare_events,
    refresh_aggregates,
    run_batch,
    run_stream,
)
from eventmetrics.plans.quality import (
    assert_quality,
    check_amounts,
    check_freshness,
    check_nulls,
    check_row_count,
    quality_report,
    report_of_statistics,
)

__all__ = [
    "assert_quality",
    "check_amounts",
    "check_freshness",
    "check_nulls",
    "check_row_count",
    "judge_messages",
    "metrics",
    "prepare_events",
    "quality_report",
    "refresh_aggregates",
    "report_of_statistics",
    "run_batch",
    "run_stream",
]
