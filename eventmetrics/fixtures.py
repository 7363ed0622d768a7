"""The given `events` table seen as clickstream events.

It has its own columns and types, so this projection maps them to the event schema. It also
makes some users NULL and leaves one event type that is not allowed, to give cleaning
something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmetrics.functions import lookback
from eventmetrics.functions.filters import AsOf

# Fixed values, in the order that the indexes below pick from.
DEVICES = ("mobile", "desktop", "tablet")
COUNTRIES = (
    "US", "GB", "DE", "FR", "CA", "AU", "IN", "BR", "JP", "MX",
    "ES", "IT", "NL", "SE", "SG", "KR", "PL", "TR", "ZA", "AR",
)
# The table as it is given.
TABLE_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
    "props STRING"
)
# The table's last event is on 2024-01-30; "now" for every look-back.
AS_OF = "2024-01-31 00:00:00"


def std_events(events: DataFrame, *more: str) -> DataFrame:
    """Rows of `events` in the event schema, and more columns of theirs as they are."""
    devices = ", ".join(f"'{d}'" for d in DEVICES)
    countries = ", ".join(f"'{c}'" for c in COUNTRIES)
    return events.selectExpr(
        "CASE WHEN event_id % 97 <> 0 THEN CAST(user_id AS STRING) END AS user_id",
        """CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'search'
                WHEN 'signup' THEN 'add_to_cart' ELSE event_type END AS event_type""",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") AS timestamp",
        "'s' || (user_id % 1000) AS session_id",
        f"get(array({devices}), CAST(event_id % 3 AS INT)) AS device",
        "'/p/' || get_json_object(props, '$.k') AS page",
        f"get(array({countries}), CAST(user_id % 20 AS INT)) AS country",
        "CASE WHEN event_id % 10 >= 7 THEN value END AS amount",
        *more,
    )


def read_std_events(spark: SparkSession, sf_dir: str, time_window: str | None = None,
                    as_of: AsOf = AS_OF) -> DataFrame:
    """The table as events; with a label, only what its look-back can reach.

    A window starts no later than its events. Filtering events by the same bound therefore
    loses nothing, and the raw time column lets Parquet skip row groups, which a filter on the
    window start cannot.
    """
    events = spark.read.schema(TABLE_SCHEMA).parquet(f"{sf_dir}/events.parquet")
    if time_window is not None:
        events = lookback(events, time_window, as_of, column="ts")
    return std_events(events)
