"""From raw documents to training sequences, in five stages.

Each stage takes what its predecessor kept and writes it as Parquet to the folder that the cluster
shares; the next one reads it from there. So a lost executor costs the tasks it was running, and
a stage can be looked at afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventmetrics.llm.common import stored
from eventmetrics.llm.decontamination import decontaminate
from eventmetrics.llm.exact_dedup import exact_dedup
from eventmetrics.llm.near_dedup import near_dedup
from eventmetrics.llm.packing import pack
from eventmetrics.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted toxic."""
    return drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 85 % similarity hold together."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and the training sequences they lie in."""
    return pack(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact_duplicates", exact_duplicates),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Trees, MinHash and token ids have no SQL; tests compare the stages with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`; returns the last one's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
