"""The stages one after another, each against what it must keep."""

import corpus_pipeline
from eventmetrics.llm import queries
from tests.llm.test_dedup import brute_force


def test_stages_keep_what_they_must(spark, table):
    docs, sf_dir = table("documents"), "/root/testdata/sf0.001"
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.stored(stage(spark, docs, sf_dir))
        assert after.columns == docs.columns
        kept[name] = {r["doc_id"]: r["text"] for r in after.select("doc_id", "text").collect()}
        docs = after
    first = kept["toxicity"]
    smallest = {}
    for i, text in sorted(first.items()):
        smallest.setdefault(" ".join(text.split()), i)
    assert set(kept["exact_duplicates"]) == set(smallest.values())
    components = brute_force(kept["exact_duplicates"])
    assert set(kept["near_duplicates"]) == {i for i, c in components.items() if i == c}
    assert set(kept["decontamination"]) < set(kept["near_duplicates"])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert {r["doc_id"] for r in packed.collect()} == set(kept["decontamination"])


def test_it_runs_on_odd_rows(spark, odd, none):
    for docs in (odd, none):
        for _, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"))


def test_queries_are_registered():
    assert {name.split("_")[0] for name in queries.QUERIES} == {
        "pipeline", *(f"op{n}" for n in range(1, 14))}
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
