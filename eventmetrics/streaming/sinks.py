"""Where events and aggregates go. Every write is distributed; none collects rows."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import TimestampType

from eventmetrics.operators import clean_events, enrich_events, faulty_messages, user_windows
from eventmetrics.operators.events import KEPT_FAULTS
from eventmetrics.operators.windows import late_events, sketch_users, to_cents
from eventmetrics.schema import (
    AGGREGATE_KEY,
    AGGREGATE_LOG_SCHEMA,
    MEASURES,
    PROGRESS_SCHEMA,
    SERVING_SCHEMA,
    USER_SKETCH,
    WINDOW_DATE,
    WINDOW_DURATION,
)
from eventmetrics.session import file_system
from eventmetrics.sources import snapshots
from eventmetrics.sources.aggregates import (
    COLUMN_TYPES,
    Target,
    jdbc_options,
    read_aggregates,
)
from eventmetrics.sources.events import FAULT_SCHEMA, LAKE_SCHEMA, LATE_SCHEMA
from eventmetrics.sources.statistics import write_statistics

LAKE_PARTITIONS = ("event_date", "event_type")
EVERY_30_SECONDS = {"processingTime": "30 seconds"}
AVAILABLE_NOW = {"availableNow": True}
DATABASE_WRITERS = 8

_DYNAMIC = ("partitionOverwriteMode", "dynamic")  # replaces the folders that are written, only


def write_event_lake(df: DataFrame, path: str, checkpoint: str | None = None,
                     trigger: Mapping | None = None,
                     mode: str = "append") -> StreamingQuery | None:
    """Enriched events as Parquet by event_date and event_type; starts a query for a stream.

    Rows are first rebalanced on the partition columns. Each folder then gets few, well-filled
    files, while adaptive execution cuts a folder that holds most of the data into several
    tasks.
    """
    balanced = df.hint("rebalance", *LAKE_PARTITIONS)
    if not df.isStreaming:
        # Sorted by time within a folder, so time filters skip row groups.
        (balanced.sortWithinPartitions(*LAKE_PARTITIONS, "event_time")
            .write.mode(mode).partitionBy(*LAKE_PARTITIONS).parquet(path))
        return None
    if not checkpoint:
        raise ValueError("a stream needs a checkpoint of its own")
    return (balanced.writeStream.format("parquet").outputMode("append")
            .option("path", path).option("checkpointLocation", checkpoint)
            .partitionBy(*LAKE_PARTITIONS).trigger(**(trigger or EVERY_30_SECONDS))
            .queryName(f"event-lake {path}").start())


def write_aggregate_log(df: DataFrame, path: str, checkpoint: str,
                        trigger: Mapping | None = None,
                        output_mode: str = "update") -> StreamingQuery:
    """Append each micro-batch's rows to a log, by window date and then by micro-batch.

    Events with their windows (the method `users`) are added up by group and user within the
    micro-batch; aggregates are written as they are. A micro-batch may run again after a failure.
    It then replaces its own folders, so nothing is counted twice. An empty micro-batch writes
    nothing; the log is there from the start, as a folder without rows.
    """
    _empty_table(df, AGGREGATE_LOG_SCHEMA, path, WINDOW_DATE)
    return (df.writeStream.foreachBatch(lambda batch, batch_id: _write_log(batch, batch_id, path))
            .outputMode(output_mode)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or EVERY_30_SECONDS))
            .queryName(f"aggregate-log {path}").start())


def write_outputs(messages: DataFrame, out: str, duration: str = WINDOW_DURATION,
                  trigger: Mapping | None = None,
                  watermark: str | None = None) -> StreamingQuery:
    """Lake, aggregate log and faulty messages from one query that decodes each message once.

    `messages` are decoded and judged (`with_fault`). A micro-batch is kept on the executors' disks
    while its parts are written: `out`/events, `out`/aggregate_log and `out`/faults, each into
    folders of the micro-batch's own. If it fails anywhere it runs again and replaces all of them, so
    they always hold the same events. An executor that is lost takes its part of the kept rows with
    it; that part is read from the source again.

    With a `watermark`, windows close: those that ended that long before the latest event of all
    earlier micro-batches. Events of closed windows are in the lake as all others, but go to
    `out`/late_events in place of the log (`with_late_events` puts both together). So a window of the
    log, once closed, does not change, and nothing is kept in state.

    Last, `out`/progress gets a row with the micro-batch's numbers. They are counted from its rows, not
    by accumulators, to which a repeated task would add twice.
    """
    lake, log, faults = f"{out}/events", f"{out}/aggregate_log", f"{out}/faults"
    late_path, progress = f"{out}/late_events", f"{out}/progress"
    _empty_table(messages, LAKE_SCHEMA, lake, *LAKE_PARTITIONS)
    _empty_table(messages, AGGREGATE_LOG_SCHEMA, log, WINDOW_DATE)
    _empty_table(messages, FAULT_SCHEMA, faults)
    _empty_table(messages, LATE_SCHEMA, late_path)
    _empty_table(messages, PROGRESS_SCHEMA, progress)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        latest, closed = _latest_before(batch.sparkSession, progress, batch_id, watermark)
        mark = F.timestamp_micros(F.lit(closed).cast("long"))
        batch = batch.persist(StorageLevel.DISK_ONLY)
        try:
            events = enrich_events(clean_events(batch))
            number = F.lit(batch_id).cast("long").alias("batch_id")
            (events.select(*LAKE_SCHEMA.fieldNames(), number).hint("rebalance", *LAKE_PARTITIONS)
                .sortWithinPartitions(*LAKE_PARTITIONS, "event_time")
                .write.mode("overwrite").option(*_DYNAMIC)
                .partitionBy(*LAKE_PARTITIONS, "batch_id").parquet(lake))
            windows, late = user_windows(events, duration), 0
            if closed is not None:
                windows = windows.filter(F.col("window_end") > mark)
                rows = late_events(events, mark, duration).select(*LAKE_SCHEMA.fieldNames(), number)
                rows.write.mode("overwrite").option(*_DYNAMIC).partitionBy("batch_id").parquet(late_path)
                late = rows.count()
            _write_log(windows, batch_id, log)
            (faulty_messages(batch).withColumn("batch_id", number).write.mode("overwrite")
                .option(*_DYNAMIC).partitionBy("batch_id").parquet(faults))
            fill = {"late_events": F.lit(late), "mark": mark, "written_at": F.current_timestamp(),
                    "batch_id": number, "latest_event_time": F.greatest(
                        "latest", F.timestamp_micros(F.lit(latest).cast("long")))}
            (_conform(_numbers(batch), PROGRESS_SCHEMA, fill).write.mode("overwrite")
                .option(*_DYNAMIC).partitionBy("batch_id").parquet(progress))
        finally:
            batch.unpersist()

    return (messages.writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", f"{out}/checkpoints/outputs")
            .trigger(**(trigger or EVERY_30_SECONDS)).queryName(f"outputs {out}").start())


def _numbers(judged: DataFrame) -> DataFrame:
    """Numbers of messages, of events and of those dropped, and the latest time of an event."""
    kept_fault = F.coalesce(F.col("fault").isin(*KEPT_FAULTS), F.lit(False))
    event = F.col("fault").isNull() | kept_fault
    return judged.agg(
        F.count("*").alias("messages"), F.count_if(event).alias("events"),
        F.count_if(~event).alias("dropped"), F.count_if(kept_fault).alias("faulty_events"),
        F.max(F.when(event, F.try_to_timestamp(F.col("timestamp")))).alias("latest"))


def _latest_before(spark: SparkSession, progress: str, batch_id: int,
                   watermark: str | None) -> tuple[int | None, int | None]:
    """The latest event time of earlier micro-batches, and that less the watermark; microseconds.

    Both are the same when a micro-batch runs again. The batch before has noted them; where it has
    not, which is so after an update of the library, the whole table is asked.
    """
    before = f"{progress}/batch_id={batch_id - 1}"
    files, where = file_system(spark, before)
    rows = spark.read.schema(PROGRESS_SCHEMA).option("basePath", progress).parquet(
        before if files.exists(where) else progress)
    latest = rows.filter(F.col("batch_id") < batch_id).agg(
        F.max("latest_event_time").alias("latest")).select(
        F.unix_micros("latest").alias("latest"),
        (F.unix_micros(F.col("latest") - F.expr(f"INTERVAL {watermark}")) if watermark
         else F.lit(None)).alias("closed")).first()
    return latest["latest"], latest["closed"]


def _empty_table(df: DataFrame, schema, path: str, *folders: str) -> None:
    """Make the table be there from the start, as a folder without rows."""
    empty = df.sparkSession.createDataFrame([], schema).drop(*folders, "batch_id")
    names = "".join(f"/{name}=__HIVE_DEFAULT_PARTITION__" for name in folders)
    empty.write.mode("ignore").parquet(f"{path}{names}/batch_id=-1")


def _write_log(batch: DataFrame, batch_id: int, path: str) -> None:
    # Few files for each date, and several tasks for a date with very many rows.
    (_log_rows(batch, batch_id).hint("rebalance", WINDOW_DATE).write.mode("overwrite")
        .option(*_DYNAMIC).partitionBy(WINDOW_DATE, "batch_id").parquet(path))


def _log_rows(df: DataFrame, batch_id: int) -> DataFrame:
    if "unique_users" not in df.columns:
        df = df.groupBy(*AGGREGATE_KEY, "user_id").agg(
            F.count("*").alias("event_count"), F.sum("amount").alias("total_revenue"))
    fill = {"user_id": F.lit(None), "unique_users": F.lit(None),
            "created_at": F.current_timestamp(), WINDOW_DATE: F.to_date("window_start"),
            "batch_id": F.lit(batch_id)}
    return _conform(df, AGGREGATE_LOG_SCHEMA, fill)


def _conform(df: DataFrame, schema, fill) -> DataFrame:
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else fill[f.name]).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


_DATED_KEY = (WINDOW_DATE, *AGGREGATE_KEY)


def _shares(log: DataFrame, *more: str) -> DataFrame:
    """The log's rows of users, added up over micro-batches."""
    return (log.filter("unique_users IS NULL").groupBy(*_DATED_KEY, "user_id", *more)
            .agg(F.sum("event_count").alias("event_count"),
                 F.sum("total_revenue").alias("total_revenue"),
                 F.max("created_at").alias("created_at")))


def _states(log: DataFrame) -> DataFrame:
    """The newest of the log's rows of states, by key and user (none, if the state is the key's)."""
    # One max_by per measure: their buffers have fixed width, so this is a hash aggregate; a
    # struct would force a sort. A batch writes a key once, so all three take the same row.
    newest = [F.max_by(name, "batch_id").alias(name) for name in (*MEASURES, "created_at")]
    return (log.filter("unique_users IS NOT NULL").groupBy(*_DATED_KEY, "user_id")
            .agg(*newest, F.max("batch_id").alias("batch_id")))


def latest_aggregates(log: DataFrame, sketch: bool = False) -> DataFrame:
    """One row per key from a log, with the window's date: filters on it skip folders of the log.

    Users' rows are added up, and their number is the distinct users. Of rows of states the newest
    counts; states of users are added up after that. With `sketch` there is a sketch of the users as
    well (NULL for states of keys, which do not know them).
    """
    columns = [*_DATED_KEY, *MEASURES, "created_at"]
    users = _shares(log).groupBy(*_DATED_KEY).agg(
        F.sum("event_count").alias("event_count"), F.count("user_id").alias("unique_users"),
        F.sum("total_revenue").alias("total_revenue"), F.max("created_at").alias("created_at"),
        *([sketch_users()] if sketch else []))
    more = [USER_SKETCH] if sketch else []
    known = F.count("user_id") == F.sum("unique_users")
    states = _states(log).groupBy(*_DATED_KEY).agg(
        *[F.sum(name).alias(name) for name in MEASURES], F.max("created_at").alias("created_at"),
        *([F.when(known, sketch_users()).alias(USER_SKETCH)] if sketch else []))
    both = users.select(*columns, *more).unionByName(states.select(*columns, *more))
    return both.withColumn("total_revenue", to_cents(F.col("total_revenue")))


def with_late_events(log: DataFrame, late: DataFrame, duration: str = WINDOW_DURATION) -> DataFrame:
    """The log with the rows that late events would have had in it; `duration` is that of its windows.

    It may be read, compacted and refreshed from as the log.
    """
    shares = user_windows(late, duration, more=("batch_id",)).groupBy(
        *AGGREGATE_KEY, "user_id", "batch_id").agg(
        F.count("*").alias("event_count"), F.sum("amount").alias("total_revenue"))
    fill = {"unique_users": F.lit(None), "created_at": F.current_timestamp(),
            WINDOW_DATE: F.to_date("window_start")}
    return log.unionByName(_conform(shares, AGGREGATE_LOG_SCHEMA, fill))


_NO_DATE = snapshots.NO_DATE


def _folder_of(date):
    return F.concat(F.lit(f"{WINDOW_DATE}="), F.coalesce(date.cast("string"), F.lit(_NO_DATE)))


def newest_batches(log: DataFrame) -> dict[str, int]:
    """The newest batch that each date's folder of a log holds rows of."""
    rows = log.groupBy(_folder_of(F.col(WINDOW_DATE)).alias("folder")).agg(
        F.max("batch_id").alias("newest"))
    return {r["folder"]: r["newest"] for r in rows.collect()}  # one row per date


def in_folders(df: DataFrame, folders: Iterable[str]) -> DataFrame:
    """The rows of some dates, given as folders' names; the filter selects folders to read."""
    dates = [folder.split("=", 1)[1] for folder in folders]
    wanted = F.col(WINDOW_DATE).isin([F.lit(d).cast("date") for d in dates if d != _NO_DATE])
    return df.filter(wanted | F.col(WINDOW_DATE).isNull() if _NO_DATE in dates else wanted)


def compact_aggregate_log(log: DataFrame, path: str) -> None:
    """Write the log with its rows merged to a new path, while its stream is stopped.

    Everything older than the last batch is merged, date by date, under the number of the newest
    batch that the date has rows of; so a refresh still knows which dates it has not taken. The
    last batch keeps its number because a restart may run it once more. Restart the stream on the
    new path with the same checkpoint.
    """
    newest = newest_batches(log)
    if not newest:
        raise ValueError("the log is empty")
    last = max(newest.values())
    older = newest_batches(log.filter(F.col("batch_id") < last))
    number = F.lit(None).cast("long")
    if older:  # one entry for each date
        number = F.create_map(*[F.lit(x) for entry in older.items() for x in entry])[
            _folder_of(F.col(WINDOW_DATE))]
    kept = F.when(F.col("batch_id") == last, F.col("batch_id")).otherwise(number).cast("long")
    users = _shares(log.withColumn("batch_id", kept), "batch_id")
    states = _states(log).withColumn("batch_id", kept)
    fill = {"user_id": F.lit(None), "unique_users": F.lit(None)}
    rows = _conform(users, AGGREGATE_LOG_SCHEMA, fill).unionByName(
        _conform(states, AGGREGATE_LOG_SCHEMA, fill))
    (rows.hint("rebalance", WINDOW_DATE).sortWithinPartitions(WINDOW_DATE, "window_start")
        .write.mode("errorifexists").partitionBy(WINDOW_DATE, "batch_id").parquet(path))


def _serving_rows(df: DataFrame) -> DataFrame:
    return _conform(df, SERVING_SCHEMA, {"created_at": F.current_timestamp(),
                                         USER_SKETCH: F.lit(None),
                                         WINDOW_DATE: F.to_date("window_start")})


def _load(df: DataFrame, path: str) -> str:
    """Write the rows into a new folder of the table, which no reader knows yet; returns its name."""
    load = uuid.uuid4().hex
    # Ranges of time within a date, so that look-backs skip row groups; the other key columns take
    # part in them because one window may hold very many rows.
    (_serving_rows(df).repartitionByRange("window_start", "event_type", "country")
        .sortWithinPartitions(WINDOW_DATE, "window_start", "event_type", "country")
        .write.partitionBy(WINDOW_DATE).parquet(f"{path}/load={load}"))
    write_statistics(df.sparkSession, path, load)
    return load


def replace_aggregates(df: DataFrame, target: Target, newest: Mapping[str, int] | None = None,
                       keep: int = snapshots.KEEP) -> DataFrame:
    """Replace all rows of the serving table; returns the table.

    Parquet has a folder for each date, within which it is laid out by window_start. Readers see the
    old rows or the new ones, never a part, and the last `keep` snapshots stay readable. `newest`
    is noted for each date's folder: the newest batch of the log that is in it.
    """
    spark = df.sparkSession
    if isinstance(target, str):
        snapshots.commit(spark, target, _load(df, target), keep_others=False, newest=newest)
        snapshots.expire_snapshots(spark, target, keep)
    else:
        _to_database(_serving_rows(df), {"truncate": "true", **target}, "overwrite")
    return read_aggregates(spark, target)


def replace_dates(df: DataFrame, path: str, newest: Mapping[str, int] | None = None,
                  drop: Iterable[str] = (), keep: int = snapshots.KEEP) -> None:
    """Replace the dates that the rows have in a serving table of Parquet, all in one step.

    Other dates stay untouched, but for the folders in `drop`, which go.
    """
    spark = df.sparkSession
    snapshots.commit(spark, path, _load(df, path), True, newest, drop)
    snapshots.expire_snapshots(spark, path, keep)


def write_aggregates_jdbc(df: DataFrame, url: str, table: str | None = None,
                          props: Mapping[str, str] | None = None) -> None:
    """Append to the serving table of a database, creating it if need be.

    Each writing task has one connection and one transaction. Pass `numPartitions` of 1 for
    a single transaction, or another number for the most connections to open.
    """
    target = {**(props or {}), "url": url}
    _to_database(_serving_rows(df), target | ({"dbtable": table} if table else {}), "append")


def database_rows(df: DataFrame) -> DataFrame:
    """The rows with times as they go into columns of type TIMESTAMP, which have no zone.

    Without the cast a database would get the time of day in the zone of the writing JVM.
    """
    times = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields
             if isinstance(f.dataType, TimestampType)}
    return df.withColumns(times)


def _to_database(rows: DataFrame, target: Mapping[str, str], mode: str) -> None:
    options = {
        "createTableColumnTypes": COLUMN_TYPES,
        "numPartitions": str(DATABASE_WRITERS),
        **jdbc_options(target),
    }
    # An exchange of its own: Spark would merge tasks down to the number of connections, and
    # with them all of the work since the last exchange.
    (database_rows(rows.drop(WINDOW_DATE, USER_SKETCH)).repartition(int(options["numPartitions"]))
        .write.format("jdbc").options(**options).mode(mode).save())
