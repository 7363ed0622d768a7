"""Session settings the engine is designed for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    # Texts without a zone resolve in the session zone, so it has to be the same everywhere.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Stream state lives off-heap on local disk with its change log in the checkpoint, so it
    # may outgrow executor memory and is rebuilt elsewhere when an executor is lost.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app_name: str = "eventmetrics", master: str | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Start (or get) a session with SETTINGS; `extra` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Resolve zone-less times as UTC in a session that somebody else started."""
    spark.conf.set("spark.sql.session.timeZone", SETTINGS["spark.sql.session.timeZone"])
    return spark


_ROOTS: dict[str, str] = {}


def file_system(spark: SparkSession, path: str):
    """Spark's own file system object and path object for a path, whatever its scheme."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _shared_dir(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    context = getattr(spark.sparkContext, "_jsc", None)
    if not shared and context is not None and context.sc().getCheckpointDir().isDefined():
        shared = context.sc().getCheckpointDir().get()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="eventmetrics-")
    return shared.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """A new, uniquely named path in the folder that all executors share.

    The folder is the session's `spark.checkpoint.dir`, or else what `setCheckpointDir` was given.
    Where neither is set a local master gets a temporary folder; on a cluster a machine-local
    folder would not be seen by the other machines, so it is an error. What is left there is
    deleted when the driver's JVM ends.
    """
    application = getattr(spark.sparkContext, "applicationId", None)
    if application is None:
        return f"{_shared_dir(spark)}/eventmetrics-{uuid.uuid4().hex}"
    if application not in _ROOTS:
        root = f"{_shared_dir(spark)}/eventmetrics-{uuid.uuid4().hex}"
        files, where = file_system(spark, root)
        files.mkdirs(where)
        files.deleteOnExit(where)
        _ROOTS[application] = root
    return f"{_ROOTS[application]}/{uuid.uuid4().hex}"
