from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
# Python workers of Spark have to import the package, too.
os.environ["PYTHONPATH"] = os.pathsep.join(
    p for p in (str(ROOT), os.environ.get("PYTHONPATH")) if p)

from eventmetrics.schema import EVENT_SCHEMA  # noqa: E402
from eventmetrics.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.maxMetadataStringLength": "2000",  # whole filters in plans
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def events(spark):
    """Make a frame of events from dictionaries; fields that are not given get a default."""
    default = {"user_id": "u1", "event_type": "page_view", "timestamp": "2026-01-15T11:00:00",
               "session_id": "s1", "device": "mobile", "page": "/home", "country": "US",
               "amount": None}

    def make(*rows: dict):
        return spark.createDataFrame(
            [tuple({**default, **row}[f] for f in EVENT_SCHEMA.fieldNames()) for row in rows],
            EVENT_SCHEMA)

    return make


@pytest.fixture(scope="session")
def std(spark):
    from eventmetrics.fixtures import read_std_events

    return read_std_events(spark, SF_DIR)


@pytest.fixture()
def four_rows(events):
    """One page view, one purchase, one event without a user, one of an unknown type."""
    return events(
        {"timestamp": "2026-01-15T10:00:00"},
        {"user_id": "u2", "event_type": "purchase", "device": "desktop", "page": "/cart",
         "session_id": "s2", "country": "UK", "amount": 49.99},
        {"user_id": None, "timestamp": "2026-01-15T12:00:00", "device": "tablet",
         "session_id": "s3", "country": "CA"},
        {"user_id": "u4", "event_type": "unknown", "timestamp": "2026-01-15T13:00:00",
         "session_id": "s4"},
    )


def rows_of(df):
    """Rows as sorted tuples of texts, for comparing frames that have no order."""
    return sorted(tuple(str(row[c]) for c in sorted(df.columns)) for row in df.collect())
