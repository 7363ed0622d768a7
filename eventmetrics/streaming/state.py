"""Windows that a stream of the method `two_level` still has open, read from its state.

A window gets into the log when it closes. Until then its rows are in the checkpoint, from where Spark
reads them as a table, partition by partition, while the stream runs or not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmetrics.operators.windows import to_cents
from eventmetrics.schema import AGGREGATE_KEY, AGGREGATE_LOG_SCHEMA, MEASURES, WINDOW_DATE
from eventmetrics.session import file_system
from eventmetrics.sources.aggregates import read_aggregate_log
from eventmetrics.streaming.sinks import latest_aggregates

# What the state holds of a user and of a group, in the order in which `two_level` adds it up. Names
# repeat there, so fields are told by their place.
_OF_USER = "struct<event_count:bigint,amount:decimal(38,6),empty:boolean>"
_OF_GROUP = "struct<event_count:bigint,unique_users:bigint,amount:decimal(38,6),empty:boolean>"


def state_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The newest micro-batch whose state is complete; None before the first one."""
    commits = f"{checkpoint}/commits"
    files, where = file_system(spark, commits)
    if not files.exists(where):
        return None
    return spark.read.format("state-metadata").load(checkpoint).agg(
        F.max("maxBatchId")).first()[0]


def _state(spark: SparkSession, checkpoint: str, operator: int, batch_id: int) -> DataFrame:
    rows = (spark.read.format("statestore").option("operatorId", operator)
            .option("batchId", batch_id).load(checkpoint))
    of_user = "user_id" in rows.schema["key"].dataType.names
    value = F.col("value").cast(_OF_USER if of_user else _OF_GROUP)
    users = (F.col("key.user_id").isNotNull().cast("long") if of_user
             else value.getField("unique_users"))
    return rows.select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"),
        "key.event_type", "key.country", value.getField("event_count").alias("event_count"),
        users.alias("unique_users"),
        F.when(~value.getField("empty"), value.getField("amount")).alias("total_revenue"))


def open_windows(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """The aggregates so far of windows that have not closed, after `batch_id` or the newest batch.

    Of a stream with distinct='two_level'; `checkpoint` is that of its query. A user's row is in the
    state once, so users of a group are counted without holding them together. There are no rows
    before the first micro-batch. Batches remain readable as long as Spark keeps them
    (`spark.sql.streaming.minBatchesToRetain`).
    """
    if batch_id is None:
        batch_id = state_batch(spark, checkpoint)
    names = [*AGGREGATE_KEY, *MEASURES]
    if batch_id is None:
        return latest_aggregates(spark.createDataFrame([], AGGREGATE_LOG_SCHEMA)).select(names)
    # A query has two such operators, whatever the data: users of groups, and groups.
    operators = spark.read.format("state-metadata").load(checkpoint).select(
        "operatorId").distinct().collect()
    if len(operators) != 2:
        raise ValueError(f"{checkpoint} has no state of distinct='two_level'")
    parts = [_state(spark, checkpoint, row[0], batch_id) for row in operators]
    return parts[0].unionByName(parts[1]).groupBy(*AGGREGATE_KEY).agg(
        *[F.sum(name).alias(name) for name in MEASURES]).withColumn(
        "total_revenue", to_cents(F.col("total_revenue")))


def windows_so_far(spark: SparkSession, log_path: str, checkpoint: str) -> DataFrame:
    """Closed windows from the log and open ones from the state, both as of one micro-batch.

    The batch is the newest whose state is complete; what a running stream has meanwhile added to the
    log is left out, so no window is there twice. Rows are those of `latest_aggregates`.
    """
    batch_id = state_batch(spark, checkpoint)
    log = read_aggregate_log(spark, log_path).filter(
        F.col("batch_id") <= F.lit(-1 if batch_id is None else batch_id))
    closed = latest_aggregates(log)
    still_open = open_windows(spark, checkpoint, batch_id).withColumns({
        WINDOW_DATE: F.to_date("window_start"), "created_at": F.current_timestamp()})
    return closed.unionByName(still_open.select(*closed.columns))
