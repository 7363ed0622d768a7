"""A Parquet table by date that is replaced as a whole, or date by date, in one step.

Each load writes a folder of its own, and then a manifest that names, for every date, the folder
that holds it. A reader resolves the newest manifest once: what it reads stays as it was, whatever is
loaded meanwhile, until the snapshot is expired. A manifest is created only if its version does
not exist yet, so of two loads at the same time one fails and nothing is lost.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from eventmetrics.session import file_system

_MANIFESTS = "_manifests"
_ENTRY = "folder STRING, load STRING, newest BIGINT"
#: Snapshots that stay readable after a load.
KEEP = 8
#: What the folder of rows without a date is called.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def statistics_folder(path: str, load: str | None = None) -> str:
    """Where the statistics of a load are, or those of all."""
    return f"{path}/_statistics" + (f"/load={load}" if load else "")


def _versions(spark: SparkSession, path: str) -> list[int]:
    files, where = file_system(spark, f"{path}/{_MANIFESTS}")
    if not files.exists(where):
        return []
    return sorted(int(f.getPath().getName().split(".")[0]) for f in files.listStatus(where)
                  if f.getPath().getName().endswith(".json"))


def _manifest(path: str, version: int) -> str:
    return f"{path}/{_MANIFESTS}/{version:012d}.json"


def _entries(spark: SparkSession, path: str, version: int) -> dict[str, tuple[str, int | None]]:
    """The load that holds each date's folder, and the newest batch in it."""
    rows = spark.read.schema(_ENTRY).json(_manifest(path, version)).filter("folder IS NOT NULL")
    return {r["folder"]: (r["load"], r["newest"]) for r in rows.collect()}  # one row per date


def current(spark: SparkSession, path: str) -> dict[str, tuple[str, int | None]] | None:
    """What the newest snapshot holds; None if there is none."""
    versions = _versions(spark, path)
    return _entries(spark, path, versions[-1]) if versions else None


def read_snapshot(spark: SparkSession, path: str, schema, version: int | None = None) -> DataFrame:
    """The rows of the newest snapshot, or of an older version that has not expired."""
    versions = _versions(spark, path)
    if not versions:
        return spark.read.schema(schema).parquet(path)  # a plain folder
    if version is not None and version not in versions:
        raise ValueError(f"{path} has no version {version}; it has {versions}")
    held = _entries(spark, path, versions[-1] if version is None else version)
    if not held:
        return spark.createDataFrame([], schema)
    folders = [f"{path}/load={load}/{folder}" for folder, (load, _) in sorted(held.items())]
    return (spark.read.schema(schema).option("basePath", path).parquet(*folders)
            .select(schema.fieldNames()))


def _folders(spark: SparkSession, path: str) -> list[str]:
    files, where = file_system(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)
            if f.isDirectory() and "=" in f.getPath().getName()]


def commit(spark: SparkSession, path: str, load: str, keep_others: bool,
           newest: Mapping[str, int] | None = None, drop: Iterable[str] = ()) -> int:
    """Make the dates that `load` has written the current ones; returns the version.

    With `keep_others` dates that it has not written stay as they are, without those in `drop`.
    """
    versions = _versions(spark, path)
    held = _entries(spark, path, versions[-1]) if versions and keep_others else {}
    held = {folder: entry for folder, entry in held.items() if folder not in set(drop)}
    for folder in _folders(spark, f"{path}/load={load}"):
        held[folder] = (load, (newest or {}).get(folder))
    version = versions[-1] + 1 if versions else 0
    lines = [json.dumps({"folder": f, "load": at, "newest": n}) for f, (at, n) in sorted(held.items())]
    files, where = file_system(spark, _manifest(path, version))
    out = files.create(where, False)
    try:
        out.write(bytearray("\n".join(lines or ["{}"]).encode()))
    finally:
        out.close()
    return version


def expire_snapshots(spark: SparkSession, path: str, keep: int = KEEP) -> list[int]:
    """Delete all but the newest snapshots, and the folders that only they used; returns these.

    Folders of a load that failed before its commit are in no snapshot and stay.
    """
    if keep < 1:
        raise ValueError("the newest snapshot has to be kept")
    versions = _versions(spark, path)
    old, kept = versions[:-keep], versions[-keep:]

    def used(those: list[int]) -> tuple[set[str], set[str]]:
        held = [(load, folder) for v in those
                for folder, (load, _) in _entries(spark, path, v).items()]
        return {f"{path}/load={load}/{folder}" for load, folder in held}, {load for load, _ in held}

    unused: set[str] = set()
    if old:
        (old_folders, old_loads), (folders, loads) = used(old), used(kept)
        unused = (old_folders - folders) | {
            statistics_folder(path, load) for load in old_loads - loads}
    for version in old:  # first, so that nobody resolves a manifest without its folders
        files, where = file_system(spark, _manifest(path, version))
        files.delete(where, False)
    for folder in sorted(unused):
        files, where = file_system(spark, folder)
        files.delete(where, True)
    return old
