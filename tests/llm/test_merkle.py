"""The manifest's trees against SQL and against trees built by hand."""

import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventmetrics.llm import queries
from eventmetrics.llm.merkle import (
    FIELDS,
    Subtree,
    address,
    audit,
    fold,
    hash_of,
    manifest,
    proof_digest,
    proofs,
)
from tests.conftest import SF_DIR
from tests.oracle import differences


def test_query_equals_sql(spark):
    name = "op13_merkle_manifest"
    assert differences(queries.QUERIES[name](spark, SF_DIR), queries.ORACLE_SQL[name], SF_DIR) == ""


@pytest.mark.parametrize("height", range(1, 11))
def test_the_layout_has_a_place_for_every_node(height):
    places = [a for d in range(height) for a in address(height, d, np.arange(1 << d)).tolist()]
    assert sorted(places) == list(range((1 << height) - 1)) and places[0] == 0


def test_the_layout_keeps_subtrees_together():
    # Half of eight levels: a top of 15 nodes, then 16 subtrees of 15 nodes, each in one stretch.
    for root in range(16):
        inside = [a for d in range(4) for a in address(
            8, 4 + d, np.arange(root << d, (root + 1) << d)).tolist()]
        assert sorted(inside) == list(range(15 + 15 * root, 30 + 15 * root))


H = lambda *texts: sha256("".join(texts).encode()).hexdigest()


def levels_of(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([H(*last[i:i + 2]) for i in range(0, len(last), 2)])
    return levels


def path_of(levels, i):
    found = []
    for level in levels[:-1]:
        beside = i ^ 1
        found.append((beside < i, level[beside]) if beside < len(level) else None)
        i >>= 1
    return found


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 16])
def test_paths_of_a_subtree_lead_to_its_root(n):
    leaves = [sha256(bytes([i])).digest() for i in range(n)]
    levels = levels_of([leaf.hex() for leaf in leaves])
    made = Subtree.build(leaves, len(levels) - 1)
    assert made.node(0, 0).hex() == levels[-1][0]
    taller = Subtree.build(leaves, len(levels) + 1)  # the last block of a larger tree
    assert taller.node(0, 0) == hash_of(hash_of(made.node(0, 0)))
    for i, leaf in enumerate(leaves):
        assert fold(leaf, made.path(i)) == made.node(0, 0)
        assert fold(leaf, taller.path(i)) == taller.node(0, 0)
        assert proof_digest(made.path(i)).hex() == H(*(s[1] for s in path_of(levels, i) if s))
        assert fold(sha256(b"other").digest(), made.path(i)) != made.node(0, 0)


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def by_hand(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    leaf = lambda r: H(*(encoded(r[c]) for c in FIELDS))
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    for name in names:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = [levels_of([leaf(r) for r in groups[name]]) for name in names]
    top = levels_of([t[-1][0] for t in trees])
    found = []
    for k, name in enumerate(names):
        for i, row in enumerate(groups[name]):
            path = path_of(trees[k], i) + path_of(top, k)
            other = row.asDict()
            if (row["doc_id"] is not None and row["n_chars"] is not None
                    and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0):
                other["n_chars"] += 1
            folded = leaf(other)
            for s in path:
                folded = H(folded) if s is None else H(s[1], folded) if s[0] else H(folded, s[1])
            found.append((row["doc_id"], leaf(row), trees[k][-1][0], top[-1][0],
                          H(*(s[1] for s in path if s)), folded, folded == top[-1][0]))
    return sorted(found, key=str)


@pytest.mark.parametrize("height", [1, 2, 3, 8])
def test_every_row_has_its_proof_whatever_the_blocks(table, height):
    docs = table("documents")
    found = sorted((tuple(r) for r in audit(docs, height=height).collect()), key=str)
    assert found == by_hand(docs.collect())
    assert {r[6] for r in found} == {True, False}


def test_manifest_of_odd_rows(odd, none):
    rows = odd.unionByName(odd.filter("doc_id in (5, 11)"))
    assert sorted((tuple(r) for r in audit(rows, height=2).collect()), key=str) == by_hand(rows.collect())
    assert audit(none).count() == 0 and manifest(none, FIELDS, "lang", "doc_id").root() is None
    one = odd.filter("doc_id = 10")
    assert [tuple(r) for r in audit(one).collect()] == by_hand(one.collect())


def test_many_groups_go_through_several_rounds(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"), F.expr("'s'").alias("source"),
        F.expr("CASE WHEN id % 40 > 0 THEN 'l' || (id % 40) END").alias("lang"),
        F.expr("id * 10").alias("n_chars"), F.expr("'text ' || id").alias("text"))
    found = sorted((tuple(r) for r in audit(docs, height=1).collect()), key=str)
    assert found == by_hand(docs.collect())
    made = manifest(docs, FIELDS, "lang", "doc_id", {"id": F.col("doc_id")}, height=1)
    assert len(made.group_rounds) == 6
    paths = proofs(made).collect()
    assert {fold(bytes(r["digest"]), bytes(r["path"])).hex() for r in paths} == {made.root()}
    assert sorted(r["id"] for r in paths) == list(range(300))
