"""What the operators share: stored intermediate tables, column names, hashed samples."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    StringType,
    StructType,
    _parse_datatype_string,
)

from eventmetrics.session import scratch_dir


def stored(df: DataFrame, *folders: str) -> DataFrame:
    """The rows, written to the folder that all executors share and read back from there.

    With `folders`, columns, there is a folder for each of their values. This cuts the lineage: a lost executor costs the tasks it was running, and a row is the
    same each time it is read.
    """
    path = scratch_dir(df.sparkSession)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of the frame has, whatever the letters' case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_fold(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else
                   doc_id.cast("string")) % folds


def map_texts(df: DataFrame, convert: Callable[[pa.RecordBatch], Iterator[dict]],
              schema: str | StructType) -> DataFrame:
    """Rows made by `convert`, which gets one Arrow batch and gives dictionaries of columns."""
    arrow = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def column(values, kind):
        if not isinstance(values, pa.Array):
            return pa.array(values, kind)
        return values if values.type == kind else values.cast(kind)

    def run(batches):
        for batch in batches:
            for columns in convert(batch):
                yield pa.RecordBatch.from_arrays(
                    [column(columns[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def lists(values, counts) -> pa.ListArray:
    """Rows of a list column: `counts[i]` of the values each."""
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int,
                    limit: int) -> DataFrame:
    """Up to `limit` labelled rows outside the held-out fold: doc_id, text and label (0 or 1).

    Rows with the smallest hashed ids are taken, so the sample does not depend on the order or
    the number of partitions. An id that is labelled several times has its largest label.
    """
    known = (labels.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                           F.col(label).cast("double").alias("label"))
             .filter("doc_id is not null and label in (0.0, 1.0)")
             .filter(crc_fold("doc_id", folds) != held_out)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    # At most `limit` rows of two numbers: small enough to be sent to every task.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    return (docs.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id")
            .limit(limit).repartition(8))


#: Tables are broadcast up to this many bytes; beyond that both sides are shuffled.
BROADCAST_BYTES = 32 << 20
_ROW_BYTES = 32  # what a row of a hash table has besides its fields


def _bytes_of(column: Column, kind: DataType) -> Column:
    """What a value takes in a row, from its own length."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint") + 16
    if isinstance(kind, StructType):
        return sum((_bytes_of(column[f.name], f.dataType) for f in kind), F.lit(16).cast("bigint"))
    if isinstance(kind, ArrayType):
        return F.coalesce(F.aggregate(
            column, F.lit(16).cast("bigint"),
            lambda total, x: total + _bytes_of(x, kind.elementType)), F.lit(0))
    return F.lit(8).cast("bigint")


def measured_bytes(df: DataFrame) -> int:
    """The bytes of a stored table's rows in memory, from one pass over their lengths."""
    of_row = sum((_bytes_of(F.col(f"`{f.name}`"), f.dataType) for f in df.schema),
                 F.lit(_ROW_BYTES).cast("bigint"))
    return df.agg(F.sum(of_row)).first()[0] or 0


def few(df: DataFrame) -> DataFrame:
    """The stored rows, marked for broadcast if they are small: their bytes are measured first."""
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def by_ids(df: DataFrame, column: str, ids: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows whose `column` is (left_semi) or is not (left_anti) in the one column of `ids`.

    The ids are stored and measured first. If they are few, the rows, with their texts, are not
    shuffled. If not, a Bloom filter of the ids, a fixed number of bytes, tells most rows without
    one of them, which then are not shuffled either.
    """
    key = fresh(df, "wanted_id")
    ids = stored(ids.toDF(key).distinct())
    if measured_bytes(ids) <= BROADCAST_BYTES:
        return df.join(F.broadcast(ids), F.col(column) == F.col(key), how)
    flag = fresh(df, "may_be_wanted")
    marked = _with_possible_ids(df, column, ids, key, flag)
    may = marked.filter(flag).drop(flag).join(ids, F.col(column) == F.col(key), how)
    return may if how == "left_semi" else may.unionByName(marked.filter(~F.col(flag)).drop(flag))


#: The filter of `by_ids`: so many bytes in all, in blocks of what bitmap_construct_agg makes.
FILTER_BYTES = 16 << 20
_BLOCK_BITS = 1 << 15


def bit_is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10)
    return F.getbit(byte.cast("bigint"), bit.bitwiseAND(7).cast("int")) == 1


def _with_possible_ids(df: DataFrame, column: str, ids: DataFrame, key: str,
                       flag: str) -> DataFrame:
    """The rows with a flag that is only false if `column` is none of the ids (or null)."""
    blocks = FILTER_BYTES * 8 // _BLOCK_BITS
    block, bitmap = fresh(df, "block_of_id"), fresh(df, "bitmap_of_block")

    def place(c: str) -> tuple[Column, Column]:
        h = F.xxhash64(F.col(c).cast("string"))
        return F.pmod(h, F.lit(blocks)), F.shiftrightunsigned(h, 40).bitwiseAND(_BLOCK_BITS - 1)

    bitmaps = stored(ids.select(place(key)[0].alias(block), place(key)[1].alias("bit"))
                     .groupBy(block).agg(F.bitmap_construct_agg("bit").alias(bitmap)))
    marked = df.withColumn(block, place(column)[0]).join(F.broadcast(bitmaps), block, "left")
    return marked.withColumn(flag, F.coalesce(
        bit_is_set(F.col(bitmap), place(column)[1]), F.lit(False))).drop(block, bitmap)
