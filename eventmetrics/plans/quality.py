"""Quality checks on the serving table: one report row per check, from one scan or from statistics.

A report has the columns check, observed, status (passed, failed, skipped) and message.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.functions.filters import AsOf, instant
from eventmetrics.schema import AMOUNT

REQUIRED = ("event_type", "window_start")
MAX_AGE = "1 day"


def _row_count() -> Column:
    return F.count("*")


def _null_count(columns: Sequence[str]) -> Column:
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return F.count_if(missing)


def _oldest(df: DataFrame, as_of: AsOf) -> Column:
    return (instant(as_of) - F.expr(f"INTERVAL {MAX_AGE}")).cast(df.schema["created_at"].dataType)


def _fresh_count(df: DataFrame, as_of: AsOf) -> Column:
    return F.count_if(F.col("created_at") > _oldest(df, as_of))


# What each check counts, whether that many is bad, and what it says when it is.
_FAILS = {
    "row_count": (lambda n: n == 0, "the table is empty"),
    "freshness": (lambda n: n == 0, f"nothing was written within {MAX_AGE}"),
    "nulls": (lambda n: n > 0, "rows lack a required value"),
    "amounts": (lambda n: n > 0, "amounts are not numbers that can be added up"),
}


def _report(df: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Run the counts in one aggregate; a check is skipped if one before it failed."""
    stopped = F.lit(False)
    rows = []
    for check in counts:
        fails, complaint = _FAILS[check]
        observed = F.col(check)
        status = (F.when(stopped, "skipped").when(fails(observed), "failed")
                  .otherwise("passed"))
        message = (F.when(stopped, "an earlier check failed").when(fails(observed), complaint)
                   .otherwise("ok"))
        rows.append(F.struct(
            F.lit(check).alias("check"), F.when(~stopped, observed).alias("observed"),
            status.alias("status"), message.alias("message")))
        stopped = stopped | fails(observed)
    return (df.agg(*[count.alias(check) for check, count in counts.items()])
            .select(F.inline(F.array(*rows))))


def check_row_count(df: DataFrame) -> DataFrame:
    """Fails if there are no rows."""
    return _report(df, {"row_count": _row_count()})


def check_nulls(df: DataFrame, columns: Sequence[str] = REQUIRED) -> DataFrame:
    """Fails if any row has a NULL in one of the columns."""
    return _report(df, {"nulls": _null_count(columns)})


def check_amounts(events: DataFrame, column: str = "amount") -> DataFrame:
    """Fails if an event's amount is no finite number of money: those count as missing in revenue."""
    amount = F.col(column).cast("double")
    return _report(events, {"amounts": F.count_if(
        amount.isNotNull() & amount.try_cast(AMOUNT).isNull())})


def check_freshness(df: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Fails if no row was created less than a day before `as_of`."""
    return _report(df, {"freshness": _fresh_count(df, as_of)})


def quality_report(df: DataFrame, columns: Sequence[str] = REQUIRED, as_of: AsOf = None,
                   freshness: bool = False) -> DataFrame:
    """Row count, then freshness if asked for, then NULLs."""
    counts = {"row_count": _row_count()}
    if freshness:
        counts["freshness"] = _fresh_count(df, as_of)
    counts["nulls"] = _null_count(columns)
    return _report(df, counts)


def report_of_statistics(statistics: DataFrame, columns: Sequence[str] = REQUIRED,
                         as_of: AsOf = None, freshness: bool = False) -> DataFrame:
    """The `quality_report` of the table that the statistics (`read_statistics`) are of."""
    def rows(wanted: Column) -> Column:
        return F.coalesce(F.sum(F.when(wanted, F.col("rows"))), F.lit(0))

    counts = {"row_count": rows(F.lit(True))}
    if freshness:
        counts["freshness"] = rows(F.col("created_at") > _oldest(statistics, as_of))
    counts["nulls"] = rows(F.arrays_overlap("missing", F.array(*[F.lit(c) for c in columns])))
    return _report(statistics, counts)


def assert_quality(df: DataFrame, columns: Sequence[str] = REQUIRED, as_of: AsOf = None,
                   freshness: bool = False) -> None:
    """Raise ValueError naming the check that failed. Takes a table, or statistics of one."""
    make = report_of_statistics if "missing" in df.columns else quality_report
    report = make(df, columns, as_of, freshness)
    failed = report.filter("status = 'failed'").collect()  # at most one row per check
    if failed:
        raise ValueError("; ".join(
            f"{row['check']}: {row['message']} (observed {row['observed']})" for row in failed))
