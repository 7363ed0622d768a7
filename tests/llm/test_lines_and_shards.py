"""Line dedup against SQL, and shards against the law of rows."""

from collections import Counter

import pytest

from eventmetrics.llm import queries
from eventmetrics.llm.line_dedup import line_dedup
from eventmetrics.llm.sharding import shard_documents
from tests.conftest import SF_DIR
from tests.oracle import differences


def test_line_query_equals_sql(spark):
    sql = queries.ORACLE_SQL["op1_line_dedup"]
    assert differences(queries.op1_line_dedup(spark, SF_DIR), sql, SF_DIR) == ""


def cut_lines(spark, texts, **how):
    rows = line_dedup(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string"), **how)
    return {r["doc_id"]: (r["text"], r["n_dropped"]) for r in rows.collect()}


def test_templates_generalise_variable_fields(spark):
    users = ["ann", "bob", "cy", "di", "ed"]
    found = cut_lines(spark, [
        f"About {u} only.\nUser {u} has logged in from host {i} at the door\nMore of {u} {u}."
        for i, u in enumerate(users)] + [
        f"Your session with {u} ends in {i} minutes or so\n{u} is {u}"
        for i, u in enumerate(users)])
    # A varying second token makes leaves of their own; a varying fourth one does not.
    assert found[0][1] == 0
    assert found[7] == ("cy is cy", 1)


def test_lines_of_fields_are_found(spark):
    words = ["alpha", "beta", "gamma", "delta", "eta"]
    found = cut_lines(spark, [
        f"{w} {w}{w} {w}s\nPage {i} of 3\nCopyright 202{i}\n2024-01-15 10:33:2{i} INFO Started\n"
        f"0{i}/01 12:0{i} INFO dfs.DataNode: Receiving block b{i} src: /10.0.0.{i} dest: /10.0.{i}.1\n12 34 56"
        for i, w in enumerate(words)] + ["1 2 3\n4 5 6", "7 8 9\n1 1 1", "2 2 2\n3 3 3"])
    assert found[2] == ("gamma gammagamma gammas", 5)
    assert found[5] == ("1 2 3\n4 5 6", 0)  # numbers only: not a template, and not equal


def test_a_text_of_very_many_lines(spark):
    lines = 50_000
    texts = ["\n".join(f"entry {i} of {k} done" if i % 2 else f"own{k}x{chr(97 + i % 26)} alone{k}{chr(97 + i % 7)}"
                       for i in range(lines)) for k in range(3)]
    found = cut_lines(spark, texts)
    assert all(found[k][1] >= lines // 2 for k in range(3))
    assert "entry" not in found[0][0]


def test_copies_of_a_text_do_not_make_lines_recur(spark):
    rows = [(i, "one line of a text\nand one more of it") for i in range(9)]
    found = line_dedup(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    assert {r["n_dropped"] for r in found} == {0}


def test_lines_of_odd_rows(odd, none):
    cut = line_dedup(odd)
    assert cut.columns == [*odd.columns, "n_lines_", "n_dropped"]
    assert cut.count() == odd.count() and line_dedup(none).count() == 0
    rows = {r["doc_id"]: r for r in cut.collect()}
    assert rows[1]["text"] is None and rows[1]["n_lines_"] == 0
    assert rows[2]["text"] == "" and rows[2]["n_lines_"] == 1
    assert rows[9]["text"] == "\n\n \t\n" and rows[9]["n_lines_"] == 4


def test_line_dedup_is_native(table):
    plan = line_dedup(table("documents"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def laws(rows, shards):
    counts = Counter(r["shard"] for r in rows)
    assert set(counts) <= set(range(shards))
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    for s in counts:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(counts[s]))


def test_shards_are_even_and_hold_copies_together(table):
    docs = table("documents", "sf0.01")
    rows = shard_documents(docs).collect()
    laws(rows, 24)
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
    groups = {}
    for r in rows:
        if r["text_group"] is not None:
            groups.setdefault(r["text_group"], set()).add(r["shard"])
    assert sum(len(s) == 1 for s in groups.values()) > 0.95 * len(groups)


def test_a_group_larger_than_a_shard_fills_few_shards(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "if(id < 150, 'same', string(id)) AS text")
    rows = shard_documents(docs, shards=8).collect()
    laws(rows, 8)
    held = Counter(r["shard"] for r in rows if r["doc_id"] < 150)
    assert sum(n for _, n in held.most_common(4)) >= 120


def test_odd_rows_are_sharded(odd, none):
    rows = shard_documents(odd, shards=3).collect()
    assert len(rows) == odd.count()
    laws(rows, 3)
    by_id = {r["doc_id"]: r for r in rows}
    assert (by_id[1]["size"], by_id[1]["text_crc32"]) == (8, 0)
    assert by_id[8]["size"] == 8 + len("été à la plage 日本語 ☃".encode())
    assert shard_documents(none).count() == 0
    assert {r["law"] for r in rows} == {"rows"} and {r["grown_shard"] for r in rows} == {None}


@pytest.mark.parametrize("n", [1, 5])
def test_fewer_rows_than_shards(spark, n):
    laws(shard_documents(spark.range(n).selectExpr("id AS doc_id", "'t' AS text")).collect(), 24)
