"""Exact duplicates by a two-pass Bloom filter, with built-in functions only.

Pass one sets a bit for each text in one block of a blocked Bloom filter, and keeps the bits that
at least two texts have set. Pass two probes every text: one with an unset bit cannot have a
copy and passes straight through; only the others are shuffled by the hash of their text and
compared. A false positive costs a shuffled row, never a wrong result.

The filter grows with the texts, so it is cut into slices of a fixed size, each for a part of the
hashes. The hashes are stored by slice, without a shuffle, and a slice's are probed with that slice
alone. Texts are never shuffled to be probed: a row finds out from a filter of the groups, one slice
after the other, whether its text is in one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import (
    BROADCAST_BYTES,
    bit_is_set,
    fresh,
    measured_bytes,
    stored,
)

BLOCK_BITS = 1 << 15  # what one row of bitmap_construct_agg holds
BITS_PER_TEXT = 16
#: What is broadcast of a filter at a time.
SLICE_BYTES = 32 << 20

# The cheap alternatives come first: most spaces stand alone and are left as they are.
_SPACES = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    """Null as empty; each run of white space as one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), _SPACES, " ")


def text_key(text: Column) -> Column:
    # Never null, and said so: joins then need no extra test that would compute it again.
    return F.coalesce(F.sha2(normalised(text), 256), F.lit(""))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column) -> Column:
    return F.xxhash64(F.lit("bits"), key).bitwiseAND(BLOCK_BITS - 1)


@dataclass
class Slices:
    """How a filter for so many texts is cut."""

    blocks: int
    blocks_each: int

    @classmethod
    def of(cls, texts: int) -> Slices:
        blocks = -(-max(1, texts) * BITS_PER_TEXT // BLOCK_BITS)
        return cls(blocks, max(1, SLICE_BYTES * 8 // BLOCK_BITS))

    @property
    def number(self) -> int:
        return -(-self.blocks // self.blocks_each)

    def slice_of(self, key: Column) -> Column:
        return F.floor(_block(key, self.blocks) / self.blocks_each).cast("int")


def repeated_bits(keys: DataFrame, key: str, blocks: int, least: int = 2) -> DataFrame:
    """First pass: bit_block and bitmap of the bits that `least` or more rows have set."""
    # One number says block and bit; a task adds up its own rows before they are shuffled.
    place = _block(F.col(key), blocks) * BLOCK_BITS + _bit(F.col(key))
    found = keys.select(place.alias("place")).groupBy("place").agg(F.count("*").alias("n"))
    return (found.filter(F.col("n") >= least)
            .groupBy(F.shiftright("place", 15).alias("bit_block"))
            .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND(BLOCK_BITS - 1)).alias("bitmap")))


def _probed(df: DataFrame, key: str, bitmaps: DataFrame, blocks: int, flag: str) -> DataFrame:
    """The rows of one slice with a flag whether its bitmaps have their bit."""
    block, bitmap = fresh(df, "bit_block_of_row"), fresh(df, "bitmap_of_block")
    side = bitmaps.select(F.col("bit_block").alias(block), F.col("bitmap").alias(bitmap))
    return (df.withColumn(block, _block(F.col(key), blocks))
            .join(F.broadcast(side), block, "left")  # SLICE_BYTES at most
            .withColumn(flag, F.coalesce(bit_is_set(F.col(bitmap), _bit(F.col(key))), F.lit(False)))
            .drop(block, bitmap))


def _possible_repeats(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text_sha256 and maybe (whether another row may have the same text) of every row."""
    keys = docs.select(F.col(doc_id).alias("doc_id"), text_key(F.col(text)).alias("text_sha256"))
    keys = stored(keys)
    slices = Slices.of(keys.count())
    if slices.number == 1:
        bitmaps = stored(repeated_bits(keys, "text_sha256", slices.blocks))
        return _probed(keys, "text_sha256", bitmaps, slices.blocks, "maybe")
    # A folder for each slice: tasks sort their own rows into them, and each is read alone.
    by_slice = stored(keys.withColumn("slice", slices.slice_of(F.col("text_sha256"))), "slice")
    found = None
    for number in range(slices.number):
        mine = by_slice.filter(F.col("slice") == number).drop("slice")
        bitmaps = stored(repeated_bits(mine, "text_sha256", slices.blocks))
        part = stored(_probed(mine, "text_sha256", bitmaps, slices.blocks, "maybe"))
        found = part if found is None else found.unionByName(part)
    return found


def duplicate_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row.

    Of equal texts the smallest doc_id stays. A null text is empty; empty texts are equal to each
    other. Rows without an id stay only if all of their group lack one (keep_id is then null).
    Rows that repeat an id and its text count towards group_size and are marked alike.
    """
    flagged = _possible_repeats(docs, doc_id, text)
    columns = ["doc_id", "keep_id", "group_size", "text_sha256"]
    alone = flagged.filter("not maybe").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        "text_sha256")
    maybe = flagged.filter("maybe")
    # Stored, so that the join below has plain scans on both sides and Spark can split a group
    # of very many copies over several tasks.
    groups = stored(maybe.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("group_size")))
    found = maybe.join(groups, "text_sha256").select(*columns)
    return alone.unionByName(found).select(
        "doc_id", "keep_id", "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: exactly one of each group of equal texts.

    Rows without a copy are not shuffled (but for some one in sixteen that look like copies in the
    filter, if the groups are too many to be broadcast). Of the others those with their
    group's smallest id stay, and only where several rows have that id are they shuffled, for one
    of them to stay. An empty table gives no rows.
    """
    key, flag, keep, one = (fresh(docs, c) for c in (
        "text_sha256", "maybe_repeated", "keep_id", "is_one"))
    maybe = _possible_repeats(docs, doc_id, text).filter("maybe")
    smallest = maybe.groupBy("text_sha256").agg(
        F.min("doc_id").alias("keep_id"), F.count("*").alias("n"))
    smallest = stored(smallest.filter("n > 1").drop("n"))
    # Of how many rows the smallest id is: of more than one only if ids repeat.
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    repeated = (maybe.join(smallest, "text_sha256").filter(same).groupBy("text_sha256")
                .agg(F.count("*").alias("n")).filter("n > 1").select("text_sha256"))
    groups = stored(smallest.join(repeated.withColumn("several", F.lit(True)), "text_sha256", "left")
                    .select(F.col("text_sha256").alias(key), F.col("keep_id").alias(keep),
                            F.col("several").isNull().alias(one)))
    keyed = docs.withColumn(key, text_key(F.col(text)))
    if measured_bytes(groups) <= BROADCAST_BYTES:
        alone, met = None, keyed.join(F.broadcast(groups), key, "left")
    else:
        flagged = _in_groups(keyed, key, groups, flag)
        alone = flagged.filter(~F.col(flag)).select(*docs.columns)
        met = flagged.filter(F.col(flag)).join(groups, key, "left")
    stays = F.col(one).isNull() | (F.col(one) & F.col(doc_id).eqNullSafe(F.col(keep)))
    kept = met.filter(stays).select(*docs.columns)
    if groups.filter(~F.col(one)).limit(1).count():
        several = met.filter(~F.col(one) & F.col(doc_id).eqNullSafe(F.col(keep)))
        kept = kept.unionByName(several.dropDuplicates([key]).select(*docs.columns))
    return kept if alone is None else alone.unionByName(kept)


def _in_groups(keyed: DataFrame, key: str, groups: DataFrame, flag: str) -> DataFrame:
    """The rows with a flag that is only false if their text is in no group.

    The texts are read once for each slice of the groups' filter, and are not shuffled.
    """
    slices = Slices.of(groups.count())
    found = None
    for number in range(slices.number):
        mine = groups.filter(slices.slice_of(F.col(key)) == number)
        bitmaps = stored(repeated_bits(mine, key, slices.blocks, least=1))
        part = keyed.filter(slices.slice_of(F.col(key)) == number)
        part = _probed(part, key, bitmaps, slices.blocks, flag)
        if slices.number > 1:
            part = stored(part)  # so that one slice at a time is held
        found = part if found is None else found.unionByName(part)
    return found
