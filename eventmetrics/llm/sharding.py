"""Documents in shards of equal size, with linked documents together as far as that allows.

Balanced label propagation: every document begins in the shard that a hash of its id names. In each
round linked documents look at the shards their neighbours are in and want to be where most of
them are, as far as these have room; a shard takes as many of those who want to come as its quota has
room for besides the linked rows it has. At the end the shards over quota hand rows to
those under it, unlinked ones first since no edge is cut by moving them, so that the numbers of
rows are at most one apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from eventmetrics.llm.common import stored

SHARDS = 24
ROUNDS = 6
#: A group of linked documents moves in clusters of at most this many rows, and an eighth of a quota.
CLUSTER_ROWS = 50_000
_ORDER_BITS = 40
_RANK_ROWS = 10_000


def _hash(bits: int, *columns) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - bits)


def _numbered(df: DataFrame, group: str, order: str, rows: int, name: str) -> DataFrame:
    """Number the rows of each group from 0 by `order`, a number of _ORDER_BITS evenly spread bits.

    Groups are cut into ranges of about _RANK_ROWS rows, which are numbered on their own, from the
    number of rows in the ranges before. So no task holds a group.
    """
    drop = 0
    while drop < _ORDER_BITS and (rows >> (_ORDER_BITS - drop - 1)) < _RANK_ROWS:
        drop += 1
    df = df.withColumn("range", F.shiftrightunsigned(F.col(order), drop))
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = df.groupBy(group, "range").agg(F.count("*").alias("n"))
    offsets = sizes.select(group, "range", F.coalesce(
        F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy(group, "range").orderBy(order, "doc_id", "text_crc32", "size")
    return (df.withColumn("inside", F.row_number().over(inside) - 1)
            .join(offsets, [group, "range"])
            .withColumn(name, (F.col("before") + F.col("inside")).cast("bigint"))
            .drop("range", "before", "inside"))


def _pick(values: list[float], index: Column) -> Column:
    return F.array(*[F.lit(v) for v in values])[index]


def _counts(df: DataFrame, column: str, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in df.groupBy(column).agg(F.count("*")).collect()}  # one per shard
    return [found.get(s, 0) for s in range(shards)]


def _propagate(linked: DataFrame, quota: float, shards: int, rounds: int) -> DataFrame:
    """Linked rows (with cluster and link_group) after the rounds."""
    for turn in range(rounds):
        load = _counts(linked, "shard", shards)
        clusters = linked.groupBy("link_group", "cluster", "shard").agg(F.count("*").alias("n"))
        # The shards of a group by how many of its members they hold, each with the room it has for
        # the group. A cluster wants the one that its place within the group falls to: the first
        # for a group that fits there, and for a larger one as few shards as hold it.
        by_size = Window.partitionBy("link_group").orderBy(F.desc("held"), "shard")
        free = F.greatest(F.lit(0.0), F.lit(quota) - _pick(load, F.col("shard")) + F.col("held"))
        offers = (clusters.groupBy("link_group", "shard").agg(F.sum("n").alias("held"))
                  .withColumn("up_to", F.sum(free).over(by_size.rowsBetween(
                      Window.unboundedPreceding, 0)))
                  .withColumn("from", F.col("up_to") - free)
                  .withColumn("members", F.sum("held").over(Window.partitionBy("link_group")))
                  .withColumnRenamed("shard", "target"))
        place = _hash(30, F.lit("place"), "cluster") / float(1 << 30) * F.col("members")
        wanted = (clusters.select("link_group", "cluster").distinct().join(offers, "link_group")
                  .filter((place >= F.col("from")) & (place < F.col("up_to")))
                  .select("link_group", "cluster", "target"))
        moving = stored(linked.join(wanted, ["link_group", "cluster"], "left").withColumn(
            "target", F.coalesce("target", "shard")))
        movers = moving.filter("shard <> target")
        coming = _counts(movers, "target", shards)
        if not sum(coming):
            break
        staying = _counts(moving.filter("shard = target"), "shard", shards)
        leaving_later = _counts(movers, "shard", shards)
        # Rows that are not let in stay where they are, so only half of them make room.
        room = [max(0.0, quota - staying[s] - leaving_later[s] / 2) for s in range(shards)]
        chance = [min(1.0, room[s] / coming[s]) if coming[s] else 0.0 for s in range(shards)]
        draw = _hash(30, F.lit(turn), "link_group", "cluster") / float(1 << 30)
        shard = F.when(draw < _pick(chance, F.col("target")), F.col("target")).otherwise(F.col("shard"))
        linked = stored(moving.withColumn("shard", shard.cast("int")).drop("target"))
    return linked


def _evened(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """The rows with shards whose numbers of rows are at most one apart."""
    counts = _counts(rows, "shard", shards)
    quota = [n // shards + (s < n % shards) for s in range(shards)]
    over = [max(0, c - q) for c, q in zip(counts, quota)]
    under = [max(0, q - c) for c, q in zip(counts, quota)]
    if not sum(over):
        return rows
    # Unlinked rows go first; linked ones by cluster.
    order = F.when(F.col("cluster").isNull(), _hash(_ORDER_BITS - 1, "doc_id", "text_crc32")).otherwise(
        F.lit(1 << (_ORDER_BITS - 1)) + F.shiftleft(_hash(19, "cluster"), 20)
        + _hash(20, "doc_id", "text_crc32"))
    ranked = _numbered(rows.withColumn("order", order), "shard", "order", n, "rank")
    place = F.col("rank") + _pick([sum(over[:s]) for s in range(shards)], F.col("shard"))
    target = F.lit(None).cast("int")
    for s in reversed(range(shards)):
        if under[s]:
            target = F.when(place < sum(under[:s + 1]), F.lit(s)).otherwise(target)
    moves = F.col("rank") < _pick(over, F.col("shard"))
    return ranked.withColumn("shard", F.when(moves, target).otherwise(F.col("shard"))).drop("order", "rank")


def shard_documents(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS,
                    doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row in one of `shards` shards; numbers of rows differ by one at most.

    Columns: doc_id, size (UTF-8 bytes of the text and 8), text_crc32, law (`rows`), shard, slot
    (numbers the rows of a shard from 0), grown_shard (null under this law) and text_group (null
    for a text without copies). Documents with equal texts are linked. A null text has no bytes
    and the checksum of an empty one, and is linked with empty texts. Rows that repeat each other,
    and rows without an id, are documents of their own. An empty table gives no rows.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    base = stored(docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        (F.octet_length(value) + 8).cast("bigint").alias("size"),
        F.crc32(value).alias("text_crc32"),
        F.struct(F.xxhash64(value).alias("a"), F.xxhash64(F.lit("text"), value).alias("b")).alias("key")))
    n = base.count()
    quota = n / shards
    limit = max(1, min(CLUSTER_ROWS, int(quota / 8)))
    groups = stored(base.groupBy("key").agg(F.count("*").alias("copies")).filter("copies > 1"))
    first = F.pmod(_hash(40, F.lit("shard"), "doc_id", "text_crc32"), F.lit(shards)).cast("int")
    clusters = F.ceil(F.col("copies") / limit)
    marked = base.join(groups, "key", "left").select(
        "doc_id", "size", "text_crc32", first.alias("shard"),
        F.when(F.col("copies").isNotNull(), F.col("key.a")).alias("link_group"),
        F.when(F.col("copies").isNotNull(), F.xxhash64("key", F.pmod(
            F.xxhash64("doc_id"), clusters))).alias("cluster"))
    marked = stored(marked)
    alone = marked.filter("cluster is null")
    linked = _propagate(marked.filter("cluster is not null"), quota, shards, rounds)
    rows = stored(_evened(stored(alone.unionByName(linked)), n, shards))
    slots = _numbered(rows.withColumn("order", _hash(_ORDER_BITS, F.lit("slot"), "doc_id", "text_crc32")),
                      "shard", "order", n // shards, "slot")
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"),
                        F.col("link_group").alias("text_group"))
