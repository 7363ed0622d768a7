"""Numbering, mixing and resampling against SQL and brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from eventmetrics.llm import queries
from eventmetrics.llm.interning import intern, padded, word_runs, xxhash64
from eventmetrics.llm.mixing import mix, mixture, share_out
from eventmetrics.llm.ranks import numbered
from eventmetrics.llm.resampling import _FOLD, _SEPARATORS, bucket_counts, resample
from tests.conftest import SF_DIR
from tests.oracle import differences


@pytest.mark.parametrize("name", ["op11_mixing", "op12_importance_resampling"])
def test_query_equals_sql(spark, name):
    query, sql = queries.QUERIES[name], queries.ORACLE_SQL[name]
    assert differences(query(spark, SF_DIR), sql, SF_DIR) == ""


# --- Numbers -------------------------------------------------------------------------------


def test_rows_are_numbered_within_groups_by_many_tasks(spark):
    rows = (spark.range(0, 6000, 1, 7).select(
        F.expr("CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 5 > 0 THEN 'g' || (id % 4) END").alias("g"),
        F.expr("pmod(hash(id), 50)").alias("v"), F.col("id").alias("place")))
    plan = numbered(rows, [F.col("v"), F.col("place")], "n", ["g"])
    assert plan.columns == ["g", "v", "place", "n"]
    found = plan.collect()
    groups = {}
    for r in found:
        groups.setdefault(r["g"], []).append(r)
    assert len(groups) == 6 and sum(map(len, groups.values())) == 6000
    for group in groups.values():
        in_order = sorted(group, key=lambda r: (r["v"], r["place"]))
        assert [r["n"] for r in in_order] == list(range(len(group)))
    assert numbered(rows.limit(0), [F.col("v")], "n").count() == 0
    assert sorted(r["n"] for r in numbered(rows, [F.lit(1)], "n").collect()) == list(range(6000))


# --- Mixing --------------------------------------------------------------------------------


def shared_by_hand(sources, most):
    """Targets by sharing the excess again until none is above."""
    targets, full = {}, set()
    total = sum(size for size, _ in sources.values())
    while True:
        rest = total - sum(most * sources[s][0] for s in full)
        weight = sum(w for s, (_, w) in sources.items() if s not in full)
        targets = {s: float(most * size) if s in full else rest * w / weight
                   for s, (size, w) in sources.items()}
        above = {s for s, t in targets.items() if s not in full and t > most * sources[s][0]}
        if not above:
            return targets
        full |= above


@pytest.mark.parametrize("seed", range(3))
def test_excess_is_shared_until_none_is_above(spark, seed):
    chance = random.Random(seed)
    sources = {i: (int(chance.choice([0, 1, 10, 1000, 50_000]) * chance.random()), chance.randrange(1, 9))
               for i in range(60)}
    frame = spark.createDataFrame([(i, *s) for i, s in sources.items()], "i int, size bigint, weight bigint")
    found = {r["i"]: r["target"] for r in share_out(frame, 3).collect()}
    expected = shared_by_hand(sources, 3)
    assert all(math.isclose(found[i], expected[i], rel_tol=1e-9, abs_tol=1e-9) for i in sources)


def test_sources_come_near_their_targets(spark):
    chance = random.Random(1)
    rows = [(i, "w " * chance.choice([1, 3, 10, 80, 300]), chance.choice(["hot"] * 5 + ["a", "b", None, "Z"]))
            for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(5)
    found = mixture(docs).collect()
    by_source = {}
    for r in found:
        by_source.setdefault(r["source"], []).append(r)
    order = ["Z", "a", "b", "hot", None]
    sizes = {s: sum(r["size"] for r in by_source[s]) for s in order}
    targets = shared_by_hand({s: (sizes[s], (1, 2, 3, 1, 2)[i]) for i, s in enumerate(order)}, 3)
    for s, group in by_source.items():
        taken = sum(r["copies"] * r["size"] for r in group)
        assert {r["source_size"] for r in group} == {sizes[s]}
        assert math.isclose(group[0]["target"], targets[s], rel_tol=1e-9)
        assert abs(taken - targets[s]) <= 300  # the longest text
        times = {r["copies"] for r in group}
        assert max(times) <= 3 and max(times) - min(times) <= 1
    again = mixture(docs.repartition(2).orderBy("text")).collect()
    assert {(r["doc_id"], r["copies"]) for r in again} == {(r["doc_id"], r["copies"]) for r in found}
    emitted = Counter(r["doc_id"] for r in mix(docs).collect())
    assert emitted == Counter({r["doc_id"]: r["copies"] for r in found if r["copies"]})


def test_odd_rows_are_mixed(odd, none):
    found = mixture(odd.withColumn("copies", F.lit("taken")))
    assert found.columns == [*odd.columns, "copies", "size", "source_size", "target", "copies_"]
    rows = {r["doc_id"]: r for r in found.collect()}
    assert found.count() == odd.count()
    assert rows[1]["size"] == rows[2]["size"] == rows[3]["size"] == rows[9]["size"] == 0
    assert rows[1]["target"] == 0 and rows[1]["copies_"] == 0  # source a has no words
    assert rows[8]["size"] == 6 and rows[11]["target"] <= 9
    assert mix(odd).columns == [*odd.columns, "copy"]
    assert mixture(none).count() == mix(none).count() == 0
    empty = mixture(odd.withColumn("text", F.lit(None).cast("string")))
    assert {(r["size"], r["target"], r["copies"]) for r in empty.collect()} == {(0, 0.0, 0)}


# --- Resampling ----------------------------------------------------------------------------


def test_hashes_and_slots_equal_the_library(spark):
    chance = random.Random(2)
    words = [bytes(chance.randrange(97, 101) for _ in range(chance.choice(
        [0, 1, 2, 3, 4, 5, 7, 8, 9, 12, 15, 16, 17, 24, 31, 32, 33, 70]))) for _ in range(3000)]
    lengths = np.array([len(w) for w in words])
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    data = padded(np.frombuffer(b"".join(words), np.uint8))
    hashes = xxhash64(data, starts, lengths)
    assert hashes.tolist() == [xxhash.xxh64_intdigest(w) for w in words]
    for keys in (hashes, hashes & np.uint64(3)):  # the second: nearly all keys collide
        table = intern(data, starts, lengths, keys)
        own = [bytes(data[a:a + n]) for a, n in zip(table.starts, table.lengths)]
        assert len(set(own)) == len(own) and [own[s] for s in table.slots] == words
        assert {w: n for w, n in zip(own, table.counts)} == Counter(words)
        assert table.checksums(data).tolist() == [zlib.crc32(w) for w in own]
    nothing = intern(padded(np.zeros(0, np.uint8)), np.zeros(0, int), np.zeros(0, int))
    assert len(nothing.slots) == len(nothing.counts) == 0


WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def features(text, longest=1):
    words = WORD.findall((text or "").translate(LOWER))
    return [" ".join(words[i:i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def test_runs_of_a_long_text_are_whole():
    long = " ".join(f"Wort{i % 1009}-x{i % 31}é" for i in range(150_000))  # over two blocks
    column = pa.array(["a B  c", None, long, "", "d", "x" * 3_000_000 + " y"])
    found = {}
    for runs in word_runs(column, _SEPARATORS, 3, _FOLD):
        for row, a, n in zip(runs.row, runs.starts, runs.lengths):
            found.setdefault(runs.first + int(row), Counter())[bytes(runs.data[a:a + n]).decode()] += 1
    for i, text in enumerate(column.to_pylist()):
        assert found.get(i, Counter()) == Counter(features(text, 3))


@pytest.mark.parametrize("longest", [1, 2])
def test_resampling_equals_brute_force(spark, table, longest):
    docs, items = table("documents"), table("benchmark")
    bucket = lambda w: zlib.crc32(w.encode()) % 500
    of = {r["doc_id"]: [bucket(f) for f in features(r["text"], longest)] for r in docs.collect()}
    s = Counter(b for f in of.values() for b in f)
    t = Counter(bucket(f) for r in items.collect() for f in features(r["text"], longest))
    big_s, big_t = sum(s.values()) + 500, sum(t.values()) + 500
    expected = {}
    for i, f in of.items():
        gain = [math.floor(1000 * math.log((t[b] + 1) * big_s / ((s[b] + 1) * big_t))) for b in f]
        h = int(hashlib.sha256(f"9:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain) // len(gain) if gain else 0
        expected[i] = (len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + .5) / 2**32))))
    words = {r["doc_id"]: len(features(r["text"])) for r in docs.collect()}
    able = sorted((i for i in of if words[i] >= 50), key=lambda i: (-expected[i][2], i))
    rank = {i: k + 1 for k, i in enumerate(able[:len(able) * 30 // 100])}
    found = resample(docs, items, buckets=500, longest=longest, seed=9, least_words=50, percent=30)
    assert {r["doc_id"]: tuple(r)[1:] for r in found.collect()} == {
        i: (*e, rank.get(i)) for i, e in expected.items()}


def test_odd_rows_are_resampled(odd, none, spark):
    items = spark.createDataFrame([(1, "the same text"), (2, None), (3, "")], "item_id int, text string")
    found = resample(odd, items, least_words=2, percent=100)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    rows = sorted(found.collect(), key=lambda r: (r["rank"] is None, r["rank"]))
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_features"] == by_id[2]["weight"] == 0 and by_id[1]["rank"] is None
    assert by_id[6]["n_features"] == by_id[7]["n_features"] == 60_002
    assert by_id[6]["weight"] == by_id[7]["weight"]
    ranked = [r for r in rows if r["rank"] is not None]
    assert [r["rank"] for r in ranked] == list(range(1, len(ranked) + 1))
    assert [r["score"] for r in ranked] == sorted((r["score"] for r in ranked), reverse=True)
    assert resample(none, items).count() == bucket_counts(none).count() == 0
    assert resample(odd, none).count() == odd.count()  # an empty target
