"""Every registered query against its SQL on the smallest data set."""

import pytest

import __spark_entry__ as contract
from tests.conftest import SF_DIR
from tests.oracle import differences

# The language-model queries have tests of their own, in a folder that may be absent.
MODEL = set(contract.llm_queries.QUERIES) if contract.llm_queries else set()
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name not in MODEL}
QUERIES = {name: query for name, query in contract.queries().items() if name not in MODEL}


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry(spark):
    assert contract.entry(spark).count() == 790


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), SQL[name], SF_DIR) == ""


RUNS_A_JOB = {"text_round_trip", "event_lake", "batch_job", "compacted_log", "log_kpi_summary",
              "distinct_users_batch", "distinct_users_stream"}


@pytest.mark.parametrize("name", sorted(
    n for n in QUERIES if n not in RUNS_A_JOB and not n.startswith(("stream_", "serving_"))))
def test_plans_stay_in_the_engine_and_join_nothing(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for slow in ("EvalPython", "InPandas", "InArrow", "Cartesian", "NestedLoop", "Broadcast",
                 "SortAggregate"):
        assert slow not in plan
    scans = 2 if name == "windowed_aggregates_6h_approx" else 1
    assert plan.count("FileScan parquet") == scans


@pytest.mark.parametrize("name", ["kpi_summary", "events_over_time_1h", "top_countries_purchase"])
def test_look_backs_reach_the_scan_of_the_events(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-" in plan.split("PushedFilters:")[1]
