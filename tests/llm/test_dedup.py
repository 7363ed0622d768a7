"""Exact and near duplicates, and components, against SQL and brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from eventmetrics.llm import common, queries
from eventmetrics.llm import near_dedup as near
from eventmetrics.llm import exact_dedup as exact
from eventmetrics.llm.common import by_ids
from eventmetrics.llm.components import connected_components
from eventmetrics.llm.exact_dedup import duplicate_groups, exact_dedup
from eventmetrics.llm.near_dedup import near_dedup, near_duplicates
from tests.conftest import SF_DIR
from tests.llm.test_hashing import shingle_set
from tests.oracle import differences


class Union(dict):
    def find(self, x):
        while self.setdefault(x, x) != x:
            x = self[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self[max(a, b)] = min(a, b)


def brute_force(texts):
    """Component of each id, from {id: text}."""
    sets, links = {i: shingle_set(t) for i, t in texts.items()}, Union()
    for a, x in sets.items():
        for b, y in sets.items():
            if a < b and x and y and 100 * len(x & y) >= 85 * len(x | y):
                links.join(a, b)
    return {i: links.find(i) for i in texts}


# --- Exact ---------------------------------------------------------------------------------


def test_exact_query_equals_sql(spark):
    sql = queries.ORACLE_SQL["op6_exact_dedup"]
    assert differences(queries.op6_exact_dedup(spark, SF_DIR), sql, SF_DIR) == ""


def test_exact_groups_of_odd_rows(odd, none):
    rows = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"])
            for r in duplicate_groups(odd).collect()]
    assert sorted(rows, key=str) == sorted([
        (None, None, 1, True), (1, 1, 2, True), (2, 1, 2, False), (3, 3, 2, True), (4, 4, 3, True),
        (5, 4, 3, False), (5, 4, 3, False), (6, 6, 2, True), (7, 6, 2, False), (8, 8, 1, True),
        (9, 3, 2, False), (10, 10, 1, True), (11, 11, 1, True)], key=str)
    assert duplicate_groups(none).count() == 0


def test_exact_dedup_keeps_one_row_of_each_group(odd, none):
    kept = exact_dedup(odd.unionByName(odd))  # each row twice
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str)
    assert ids == sorted([None, 1, 3, 4, 6, 8, 10, 11], key=str)
    assert exact_dedup(none).count() == 0


def text_exchanges(df):
    """Exchanges of the plan that move the text."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    found = []
    for i, line in enumerate(plan):
        if "Exchange " in line and "Broadcast" not in line:
            depth = len(line) - len(line.lstrip(" :+-|"))
            below = []
            for other in plan[i + 1:]:
                if len(other) - len(other.lstrip(" :+-|")) <= depth:
                    break
                below.append(other)
            if any("FileScan" in x and "text:string" in x for x in below):
                found.append(line)
    return found


@pytest.mark.parametrize("limits", [(32 << 20, 32 << 20), (0, 32 << 20), (0, 4096)])
def test_unique_texts_are_not_shuffled_whatever_the_limits(spark, table, odd, monkeypatch, limits):
    monkeypatch.setattr(exact, "BROADCAST_BYTES", limits[0])
    monkeypatch.setattr(exact, "SLICE_BYTES", limits[1])
    docs = table("documents", "sf0.01")
    kept = exact_dedup(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    if limits[0]:
        assert text_exchanges(kept) == []
    groups = {}
    for r in docs.collect():
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", r["text"]), []).append(r["doc_id"])
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(map(min, groups.values()))
    again = exact_dedup(odd.unionByName(odd)).select("doc_id").collect()
    assert sorted((r[0] for r in again), key=str) == sorted([None, 1, 3, 4, 6, 8, 10, 11], key=str)
    found = duplicate_groups(docs).collect()
    assert {r["doc_id"]: (r["keep_id"], r["group_size"]) for r in found} == {
        i: (min(g), len(g)) for g in groups.values() for i in g}


def test_rows_that_look_like_copies_are_few(spark, monkeypatch):
    """Beyond the limit only rows that the filter lets through are shuffled."""
    keys = spark.range(20_000).selectExpr("sha2(string(id), 256) AS k")
    copies = keys.limit(500)
    slices = exact.Slices.of(500)
    bitmaps = exact.repeated_bits(copies, "k", slices.blocks, least=1)
    through = exact._probed(keys, "k", bitmaps, slices.blocks, "f").filter("f")
    assert 500 <= through.count() < 500 + 20_000 // 12
    assert through.join(copies, "k").count() == 500


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_rows_by_many_ids(spark, odd, monkeypatch, how):
    ids = spark.createDataFrame([(1,), (5,), (11,), (99,), (None,)], "i bigint")
    expected = odd.join(ids, odd.doc_id == ids.i, how).count()
    assert by_ids(odd, "doc_id", ids, how).count() == expected
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    found = by_ids(odd, "doc_id", ids, how)
    assert found.columns == odd.columns and found.count() == expected
    assert by_ids(odd, "doc_id", ids.limit(0), how).count() == (0 if how == "left_semi" else odd.count())


# --- Components ------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_links(spark, seed):
    chance = random.Random(seed)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(180)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (None, 3)]  # a chain
    expected = Union()
    for a, b in links:
        if a is not None:
            expected.join(a, b)
    found = connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    assert {r["id"]: r["component"] for r in found} == {i: expected.find(i) for i in list(expected)}
    assert len(found) == len(expected)


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# --- Near ------------------------------------------------------------------------------------


def varied(base, changes, chance):
    found = base.split()
    for _ in range(changes):
        found[chance.randrange(len(found))] = f"new{chance.randrange(10**6)}"
    return " ".join(found)


@pytest.mark.parametrize("seed", range(2))
def test_near_duplicates_equal_brute_force(spark, seed):
    chance = random.Random(seed)
    texts = {}
    for g in range(12):  # groups around the limit, of short and long texts
        size = chance.choice([3, 6, 12, 40, 150, 400])
        base = " ".join(f"w{chance.randrange(5000)}" for _ in range(size))
        for _ in range(chance.randrange(1, 9)):
            texts[len(texts)] = varied(base, chance.randrange(0, 1 + size // 40 * 2), chance)
    base = " ".join(f"h{i}" for i in range(120))
    for _ in range(150):  # a hot group, some linked and some not
        texts[len(texts)] = varied(base, chance.randrange(0, 5), chance)
    texts |= {len(texts): "", len(texts) + 1: None, len(texts) + 2: "\t \n"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    expected = brute_force(texts)
    found = {r["doc_id"]: r for r in near_duplicates(docs).collect()}
    assert {i: r["component_id"] for i, r in found.items()} == expected
    assert {i: r["n_shingles"] for i, r in found.items()} == {
        i: len(shingle_set(t)) for i, t in texts.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.values())
    kept = {r["doc_id"] for r in near_dedup(docs).collect()}
    assert kept == {i for i, c in expected.items() if i == c}


def alike(n, words, changed, seed=1):
    """Texts that are alike: a common text, of which each has changed a run of words."""
    draw = random.Random(seed)
    base = [f"w{i}" for i in range(words)]
    texts = {}
    for i in range(n):
        own, at = list(base), draw.randrange(words - changed)
        own[at:at + changed] = [f"x{draw.randrange(10 ** 6)}" for _ in range(changed)]
        texts[i] = " ".join(own)
    return texts


def test_links_within_open_buckets_equal_brute_force(spark, monkeypatch):
    texts = alike(150, 100, 14)
    for i in range(0, 60, 3):  # near copies of some
        words = texts[i].split()
        words[-1 if i % 2 else 0] = "changed"
        texts[1000 + i] = " ".join(words)
    refined = []
    rare = near._rare_shingles
    monkeypatch.setattr(near, "_rare_shingles", lambda m, s, p: refined.append(rare(m, s, p)) or refined[-1])
    df = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    expected = brute_force(texts)
    assert found == expected and len(set(expected.values())) > 50
    # Of two texts' 6,000 pairs only some share a rare shingle: far fewer than all.
    buckets = refined[0].select(F.explode("bands").alias("bucket"))
    rows = buckets.groupBy("bucket").count().selectExpr("sum(count * (count - 1)) / 2").first()[0]
    assert len(refined) == 1 and rows < 150 * 149 / 2


def test_near_duplicates_of_odd_rows(odd, none):
    found = {}
    for r in near_duplicates(odd).collect():
        found.setdefault(r["doc_id"], set()).add((r["n_shingles"], r["component_id"], r["kept"]))
    assert found[None] == {(4, None, True)} and found[1] == {(0, 1, True)}
    assert found[2] == {(0, 2, True)} and found[5] == {(4, 4, False)}
    assert found[7] == {(next(iter(found[6]))[0], 6, False)}
    kept = near_dedup(odd)
    assert kept.columns == odd.columns
    ids = sorted((r["doc_id"] for r in kept.select("doc_id").collect()), key=str)
    assert ids == sorted([None, 1, 2, 3, 4, 6, 8, 9, 10, 11], key=str)
    assert near_duplicates(none).count() == near_dedup(none).count() == 0


def test_an_id_with_two_texts_joins_both_groups(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    docs = spark.createDataFrame([(1, a), (2, a), (2, b), (3, b)], "doc_id bigint, text string")
    assert {r["component_id"] for r in near_duplicates(docs).collect()} == {1}


def test_a_lower_similarity_is_refused(odd):
    with pytest.raises(ValueError, match="85"):
        near_duplicates(odd, percent=80)
