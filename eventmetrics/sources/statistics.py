"""What quality checks need to know of a stored table, gathered when it is loaded.

Next to a load's files there is a small table: for each date, time of writing and set of columns
that are NULL, the number of rows. Reports read it in place of the table. Numbers are counted from the
files that were written, so a task that ran twice counts once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmetrics.schema import SERVING_SCHEMA, USER_SKETCH, WINDOW_DATE
from eventmetrics.session import file_system
from eventmetrics.sources.snapshots import NO_DATE, current, read_snapshot, statistics_folder

STATISTICS = f"{WINDOW_DATE} DATE, created_at TIMESTAMP, missing ARRAY<STRING>, rows BIGINT"
_COLUMNS = [name for name in SERVING_SCHEMA.fieldNames() if name != USER_SKETCH]


def gather_statistics(table: DataFrame) -> DataFrame:
    """window_date, created_at, missing (names of the columns that are NULL) and rows of a table."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in _COLUMNS]))
    return (table.groupBy(WINDOW_DATE, "created_at", missing.alias("missing"))
            .agg(F.count("*").alias("rows")))


def write_statistics(spark: SparkSession, path: str, load: str) -> None:
    """Gather the statistics of a load that has been written."""
    rows = spark.read.schema(SERVING_SCHEMA).parquet(f"{path}/load={load}")
    gather_statistics(rows).write.parquet(statistics_folder(path, load))


def read_statistics(spark: SparkSession, path: str) -> DataFrame:
    """The statistics of the newest snapshot; the table itself is not read.

    A table with a load that has none, from an older version, is scanned.
    """
    held = current(spark, path)
    loads = sorted({load for load, _ in (held or {}).values()})
    folders = [statistics_folder(path, load) for load in loads]
    if held is None or not all(_exists(spark, folder) for folder in folders):
        return gather_statistics(read_snapshot(spark, path, SERVING_SCHEMA))
    if not held:
        return spark.createDataFrame([], STATISTICS)
    folder = F.concat(F.lit(f"{WINDOW_DATE}="),
                      F.coalesce(F.col(WINDOW_DATE).cast("string"), F.lit(NO_DATE)))
    # A date that a later load has replaced does not count in the earlier one.
    counts = F.lit(False)
    for load in loads:
        dates = [name for name, (of, _) in held.items() if of == load]
        counts = counts | ((F.col("load") == load) & folder.isin(dates))
    rows = (spark.read.schema(f"{STATISTICS}, load STRING")
            .option("basePath", statistics_folder(path)).parquet(*folders))
    return rows.filter(counts).select(WINDOW_DATE, "created_at", "missing", "rows")


def _exists(spark: SparkSession, path: str) -> bool:
    files, where = file_system(spark, path)
    return files.exists(where)
