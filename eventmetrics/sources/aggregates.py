"""Reading the serving table and the aggregate log.

A target is either the path of a Parquet folder or a mapping of Spark JDBC options
(`url`, `dbtable`, `user`, ...).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from eventmetrics.schema import AGGREGATE_LOG_SCHEMA, SERVING_SCHEMA
from eventmetrics.sources.snapshots import read_snapshot

Target = str | Mapping[str, str]

# Name and column widths of the serving table in a database.
TABLE = "event_aggregates"
COLUMN_TYPES = (
    "event_type VARCHAR(50), country VARCHAR(10), "
    "event_count BIGINT, unique_users BIGINT, total_revenue NUMERIC(38,2)"
)


def jdbc_options(target: Mapping[str, str]) -> dict[str, str]:
    """JDBC options with the table's name and sizes filled in where they are not given."""
    if not target.get("url"):
        raise ValueError("a JDBC target needs the option 'url'")
    defaults = {"batchsize": "10000", "fetchsize": "10000"}
    if "query" not in target:
        defaults["dbtable"] = TABLE
    if {"lowerBound", "upperBound", "numPartitions"} <= set(target):
        defaults["partitionColumn"] = "window_start"
    return {**defaults, **target}


def read_aggregates(spark: SparkSession, target: Target,
                    predicates: Sequence[str] | None = None) -> DataFrame:
    """The serving table. Filters and columns are pushed into Parquet or the database.

    From Parquet it has the date of each window as well, and is the newest snapshot: loads that come
    later do not change what this frame reads. From a database it arrives in one task,
    unless `predicates` (disjoint SQL conditions, one task each) or the options `lowerBound`,
    `upperBound` and `numPartitions` split the read, by window_start if no `partitionColumn` is
    given.
    """
    if isinstance(target, str):
        return read_snapshot(spark, target, SERVING_SCHEMA)
    options = jdbc_options(target)
    if predicates:
        if "dbtable" not in options:
            raise ValueError("predicates split a table ('dbtable'), not a 'query'")
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.format("jdbc").options(**options).load()


def read_aggregate_log(spark: SparkSession, path: str) -> DataFrame:
    """Every row that a stream's micro-batches wrote, with its `batch_id`."""
    return spark.read.schema(AGGREGATE_LOG_SCHEMA).parquet(path)
