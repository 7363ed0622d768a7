"""A Merkle manifest of a data set: a tree of digests for each group of rows, and one over the groups.

Rows are leaves. The leaves of a group are cut into aligned blocks of 2 ** BLOCK_HEIGHT, each is one
subtree, and the roots of the blocks are the leaves of the next round, until a group has one root;
the groups' roots go through the same rounds once more. A block's nodes are stored in a van Emde
Boas layout: the tree is split at half its height, the top half comes first and then one subtree
after the other, each laid out in the same way, so that a path touches few stretches of memory
whatever their length. Where a node is follows from its depth and index by arithmetic.

Paths are handed down from the last round to the first, a block at a time. A block with its nodes and
the path above it is all that a task holds.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import map_texts, stored
from eventmetrics.llm.ranks import numbered

BLOCK_HEIGHT = 8
DIGEST = 32
#: What stands beside a node on a path: nothing, or a sibling on its left or right.
ALONE, LEFT, RIGHT = 0, 1, 2
_STEP = 1 + DIGEST


def encoded(column: Column) -> Column:
    """A value as it goes into a leaf: `-` for null, else its UTF-8 byte count, `:` and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values of a row."""
    return F.sha2(F.concat(*map(encoded, columns)), 256)


def hash_of(*digests: bytes) -> bytes:
    """Digest of digests, which go in as hex text, one after the other."""
    return sha256("".join(d.hex() for d in digests).encode()).digest()


def address(height: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes at a depth (the root's is 0) are in the layout of a tree with `height` levels."""
    if height <= 1:
        return np.zeros(len(index), np.int64)
    top = height // 2
    if depth < top:
        return address(top, depth, index)
    bottom, below = height - top, depth - top
    subtree, inner = index >> below, index & ((1 << below) - 1)
    return (1 << top) - 1 + subtree * ((1 << bottom) - 1) + address(bottom, below, inner)


@lru_cache
def _row(height: int, depth: int) -> list[int]:
    """The addresses of all nodes at a depth, from left to right."""
    return address(height, depth, np.arange(1 << depth)).tolist()


@dataclass
class Subtree:
    """`leaves` digests and the nodes above them, `steps` levels up to the block's root."""

    leaves: int
    steps: int
    nodes: bytearray  # in the layout; places without a node are zero

    @classmethod
    def build(cls, digests: Sequence[bytes], steps: int) -> Subtree:
        height = steps + 1
        tree = cls(len(digests), steps, bytearray(DIGEST * ((1 << height) - 1)))
        for depth in range(steps, -1, -1):
            if depth < steps:
                digests = [hash_of(*digests[i:i + 2]) for i in range(0, len(digests), 2)]
            for at, digest in zip(_row(height, depth), digests):
                tree.nodes[DIGEST * at:DIGEST * (at + 1)] = digest
        return tree

    def node(self, depth: int, index: int) -> bytes:
        at = DIGEST * _row(self.steps + 1, depth)[index]
        return bytes(self.nodes[at:at + DIGEST])

    def path(self, leaf: int) -> bytes:
        """What stands beside the leaf and the nodes above it, up to the block's root."""
        out, count = [], self.leaves
        for depth in range(self.steps, 0, -1):
            beside = leaf ^ 1
            if beside < count:
                out += [bytes([LEFT if beside < leaf else RIGHT]), self.node(depth, beside)]
            else:
                out += [bytes([ALONE]), bytes(DIGEST)]
            leaf, count = leaf >> 1, (count + 1) >> 1
        return b"".join(out)


def _steps(path: bytes):
    for at in range(0, len(path), _STEP):
        yield path[at], path[at + 1:at + _STEP]


def fold(leaf: bytes, path: bytes) -> bytes:
    """The root that a leaf and a path lead to."""
    for side, beside in _steps(path):
        leaf = (hash_of(leaf) if side == ALONE else
                hash_of(beside, leaf) if side == LEFT else hash_of(leaf, beside))
    return leaf


def proof_digest(path: bytes) -> bytes:
    """Digest of the siblings on a path, from the leaf up."""
    return hash_of(*(beside for side, beside in _steps(path) if side != ALONE))


# --- Rounds over blocks ------------------------------------------------------------------


def _in_blocks(leaves: DataFrame, height: int, *more: str) -> DataFrame:
    """tree, block and its leaves in order, from rows (tree, place, digest and more)."""
    # At most 2 ** height rows come together.
    return (leaves.groupBy("tree", F.shiftright("place", height).alias("block"))
            .agg(F.array_sort(F.collect_list(F.struct("place", "digest", *more))).alias("leaf")))


def _built(blocks: DataFrame, height: int) -> DataFrame:
    """One row for each block (tree, block, leaf), stored, with its root and nodes."""

    def build(batch: pa.RecordBatch):
        tree, block, last, digests = (batch.column(i) for i in range(4))
        made = []
        for i in range(batch.num_rows):
            of_block = digests[i].as_py()
            # Blocks of a larger tree go up all the way, also the last and shorter one.
            steps = height if last[i].as_py() else (len(of_block) - 1).bit_length()
            made.append(Subtree.build(of_block, steps))
        yield {"tree": tree, "block": block, "leaves": [m.leaves for m in made],
               "steps": [m.steps for m in made], "root": [m.node(0, 0) for m in made],
               "nodes": [bytes(m.nodes) for m in made]}

    last = stored(blocks.groupBy("tree").agg(F.max("block").alias("last")))
    return stored(map_texts(
        blocks.join(last, "tree").select("tree", "block", "last", F.col("leaf.digest")), build,
        "tree bigint, block bigint, leaves int, steps int, root binary, nodes binary"))


def _rounds(blocks: DataFrame, height: int) -> list[DataFrame]:
    """The built blocks of each round, the last of which has one block for each tree."""
    found = [_built(blocks, height)]
    while found[-1].filter("block > 0").limit(1).count():
        roots = found[-1].select("tree", F.col("block").alias("place"), F.col("root").alias("digest"))
        found.append(_built(stored(_in_blocks(roots, height)), height))
    return found


def _paths(built: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """The path of each leaf of the built blocks (tree, block: its place), from those above them."""

    def run(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            tree, block, leaves, steps, nodes, path = (column[i].as_py() for column in batch.columns)
            made, first = Subtree(leaves, steps, nodes), block << height
            yield {"tree": [tree] * leaves, "block": range(first, first + leaves),
                   "above": [made.path(k) + path for k in range(leaves)]}

    met = built.drop("root").join(above, ["tree", "block"])
    return stored(map_texts(met, run, "tree bigint, block bigint, above binary"))


def _above_blocks(rounds: list[DataFrame], above: DataFrame, height: int) -> DataFrame:
    """The paths above the blocks of the first round, from a path above each tree.

    A tree that has its root in an earlier round than others has one leaf in the later ones, and no
    steps there.
    """
    paths = above.withColumn("block", F.lit(0).cast("bigint"))
    for built in reversed(rounds[1:]):
        paths = _paths(built, paths, height)
    return paths


# --- The manifest ------------------------------------------------------------------------


@dataclass
class Manifest:
    """The stored tables of a manifest. No row of them holds more than a block."""

    height: int
    leaves: DataFrame  # tree, block, its leaves: place, digest and what is carried along
    rounds: list[DataFrame]  # built blocks over them
    groups: DataFrame  # tree, the group's value, subroot
    group_rounds: list[DataFrame]  # built blocks over the groups' roots

    def root(self) -> str | None:
        """The root of all, in hex; None if there are no rows."""
        found = self.group_rounds[-1].select(F.lower(F.hex("root"))).first()  # one row
        return found[0] if found else None


def manifest(docs: DataFrame, columns: Sequence[str], group: str, order: str,
             carry: dict[str, Column] | None = None, height: int = BLOCK_HEIGHT) -> Manifest:
    """The trees over all rows, a leaf for each row from `columns`.

    The rows of each value of `group` (null is one) are a tree, in the order of `order` (nulls
    first, then by digest), and their roots, ordered by the value, are the tree over all. Rows that
    repeat each other are leaves of their own. `carry` has further columns to keep with the leaves.
    """
    carry = carry or {}
    base = stored(docs.select(
        F.col(group).cast("string").alias("group"), F.col(order).alias("order"),
        F.unhex(leaf_digest([F.col(c) for c in columns])).alias("digest"),
        *[c.alias(f"carried_{name}") for name, c in carry.items()]))
    names = stored(numbered(base.select(F.col("group").alias("name")).distinct(),
                            [F.asc_nulls_first("name")], "tree"))
    placed = numbered(base, [F.asc_nulls_first("order"), F.col("digest")], "place", ["group"])
    leaves = stored(_in_blocks(
        placed.join(names, F.col("group").eqNullSafe(F.col("name"))),
        height, *[F.col(f"carried_{name}").alias(name) for name in carry]))
    rounds = _rounds(leaves, height)
    roots = rounds[-1].select("tree", F.col("root").alias("subroot"))
    groups = stored(names.join(roots, "tree"))
    over = stored(_in_blocks(groups.select(
        F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("place"),
        F.col("subroot").alias("digest")), height))
    return Manifest(height, leaves, rounds, groups, _rounds(over, height))


def proofs(of: Manifest, candidate: str | None = None, paths: bool = True) -> DataFrame:
    """Every leaf with `path` (what stands beside it up to the root of all) and `proof`, its digest.

    With `candidate`, a carried digest, `folded` is the root that it (or, where it is null, the leaf
    itself) leads to on that path.
    """
    none = of.groups.sparkSession.range(0, 1, 1, 1).select(
        F.col("id").alias("tree"), F.lit(b"").alias("above"))
    over = _above_blocks(of.group_rounds, none, of.height)
    above = _paths(of.group_rounds[0], over, of.height).select(
        F.col("block").alias("tree"), "above")
    mask = (1 << of.height) - 1

    def run(batch: pa.RecordBatch):
        for i in range(batch.num_rows):
            tree, leaves, steps, nodes, path = (column[i].as_py() for column in batch.columns[:5])
            made, leaf = Subtree(leaves, steps, nodes), batch.column(5)[i].values
            found = [made.path(place & mask) + path for place in leaf.field("place").to_pylist()]
            row = {"tree": [tree] * leaves, "leaf": leaf, "proof": map(proof_digest, found)}
            if paths:
                row["path"] = found
            if candidate:
                own = zip(leaf.field(candidate).to_pylist(), leaf.field("digest").to_pylist(), found)
                row["folded"] = [fold(c or d, p) for c, d, p in own]
            yield {name: value if isinstance(value, pa.Array) else list(value)
                   for name, value in row.items()}

    met = (of.rounds[0].join(_above_blocks(of.rounds, above, of.height), ["tree", "block"])
           .join(of.leaves, ["tree", "block"])
           .select("tree", "leaves", "steps", "nodes", "above", "leaf"))
    kind = of.leaves.schema["leaf"].dataType.elementType.simpleString()
    schema = f"tree bigint, leaf {kind}, proof binary" + (
        ", path binary" if paths else "") + (", folded binary" if candidate else "")
    found = map_texts(met, run, schema)
    return found.select("tree", "leaf.*", *found.columns[2:])


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Rows whose crc32 of the id this divides are tampered with in `audit`.
TAMPERED = 7


def audit(docs: DataFrame, doc_id: str = "doc_id", fields: Sequence[str] = FIELDS,
          group: str = "lang", count: str = "n_chars", every: int = TAMPERED,
          height: int = BLOCK_HEIGHT) -> DataFrame:
    """The manifest's proofs, and whether they hold for rows of which some are tampered with.

    Columns: doc_id, leaf, subroot, root and proof_sha256 of the rows as they are, folded_root (of
    the row after tampering, with the original siblings) and verified (whether that is the root).
    Tampering adds one to `count` where `every` divides the crc32 of the id; nulls stay, and
    rows without an id are left alone. No rows give no rows.
    """
    hit = F.coalesce(F.crc32(F.col(doc_id).cast("string")) % every == 0, F.lit(False))
    changed = leaf_digest([F.when(hit, F.col(c) + 1).otherwise(F.col(c)) if c == count else F.col(c)
                           for c in fields])
    # The digest is made again only where a row differs.
    found = manifest(docs, fields, group, doc_id, {
        "doc_id": F.col(doc_id),
        "tampered": F.when(hit & F.col(count).isNotNull(), F.unhex(changed))}, height)
    root = F.lit(found.root()).cast("string")
    rows = proofs(found, "tampered", paths=False).join(
        found.groups.select("tree", "subroot"), "tree")

    def text(c):
        return F.lower(F.hex(c))

    return rows.select(
        "doc_id", text("digest").alias("leaf"), text("subroot").alias("subroot"),
        root.alias("root"), text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"), (text("folded") == root).alias("verified"))
