"""Held-out accuracy of the three classifiers, and rows that they must not fail on."""

import zlib

import pytest

from eventmetrics.llm.language_id import language_id
from eventmetrics.llm.quality import quality
from eventmetrics.llm.toxicity import drop_toxic, toxicity


def fold(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def held_out_results(found, labels, label):
    truth = {r["doc_id"]: r[label] for r in labels.collect()}
    rows = [r for r in found.collect() if r["held_out"] and truth.get(r["doc_id"]) is not None]
    return [(truth[r["doc_id"]], r["predicted"], r["score"]) for r in rows]


def auc(results):
    good = [s for t, _, s in results if t == 1]
    bad = [s for t, _, s in results if t == 0]
    return sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))


def test_language_of_held_out_texts(table):
    docs = table("documents", "sf0.01")
    truth = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = language_id(docs).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if fold(i, 4) == 2}
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) > 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_does_not_use_held_out_rows_or_the_column(spark, table):
    docs = table("documents")
    hidden = docs.selectExpr("doc_id", "text", "if(crc32(string(doc_id)) % 4 = 2, 'xx', lang) AS lang")
    key = lambda r: r["doc_id"]
    assert sorted(language_id(docs).collect(), key=key) == sorted(language_id(hidden).collect(), key=key)


def test_language_of_odd_rows(odd, none):
    rows = {r["doc_id"]: r for r in language_id(odd).collect()}
    for i in (1, 2, 3, 9, 11):
        assert (rows[i]["lang_pred"], rows[i]["score"]) == ("und", 0.0)
    assert rows[8]["lang_pred"] in ("en", "fr") and rows[None]["held_out"] is False
    assert language_id(none).count() == 0
    unlabelled = language_id(odd.selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {r["lang_pred"] for r in unlabelled.collect()} == {"und"}


def test_unseen_words_back_off_to_n_grams(spark):
    known = {"aa": "lorem ipsum dolor sit amet", "bb": "zwanzig zwölf zwischen zweifel zwerg"}
    rows = [(i, text, lang) for i, (lang, text) in
            enumerate([(k, v) for k, v in known.items()] * 20)]
    rows += [(1000, "loremipsum dolorem", None), (1001, "zwischenzwerg", None)]
    found = {r["doc_id"]: r["lang_pred"] for r in language_id(
        spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()}
    assert (found[1000], found[1001]) == ("aa", "bb")


@pytest.mark.parametrize("name, score, folds, least", [
    ("toxic", toxicity, 5, 0.93), ("quality", quality, 4, 0.98)])
def test_labels_of_held_out_texts(table, name, score, folds, least):
    docs, labels = table("documents", "sf0.1"), table("labels", "sf0.1")
    found = score(docs, labels)
    results = held_out_results(found, labels, name)
    assert len(results) > 50 and auc(results) > least
    assert found.count() == docs.count()
    other = 0 if folds == 5 else 2
    assert {r["doc_id"] for r in found.collect() if r["held_out"]} == {
        r["doc_id"] for r in docs.select("doc_id").collect() if fold(r["doc_id"], folds) == other}


@pytest.mark.parametrize("name, score", [("toxic", toxicity), ("quality", quality)])
def test_held_out_labels_are_not_used(table, name, score):
    docs, labels = table("documents"), table("labels")
    fold_of = "crc32(string(doc_id)) % 5 = 0" if name == "toxic" else "crc32(string(doc_id)) % 4 = 2"
    changed = labels.selectExpr("doc_id", f"if({fold_of}, 1 - {name}, {name}) AS {name}")
    key = lambda r: r["doc_id"]
    assert sorted(score(docs, labels).collect(), key=key) == sorted(
        score(docs, changed).collect(), key=key)


@pytest.mark.parametrize("name, score", [("toxic", toxicity), ("quality", quality)])
def test_scores_of_odd_rows(spark, odd, none, table, name, score):
    labels = spark.createDataFrame(
        [(i, i % 2) for i in range(1, 12)] + [(None, 1), (4, None), (5, 7), (6, 0), (6, 1)],
        f"doc_id bigint, {name} int")
    rows = score(odd, labels).collect()
    assert len(rows) == odd.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in rows)
    assert score(none, labels).count() == 0
    for only in (0, 1):
        alike = spark.createDataFrame([(i, only) for i in range(1, 12)], f"doc_id bigint, {name} int")
        assert {r["score"] for r in score(odd, alike).collect()} == {float(only)}
    assert {r["score"] for r in score(odd, labels.limit(0)).collect()} == {0.0}


def test_insults_are_dropped_and_clean_texts_stay(spark, table):
    docs, labels = table("documents", "sf0.01"), table("labels", "sf0.01")
    text = docs.filter("doc_id = 1").first()["text"]
    words = text.split()
    bad = " ".join(w + " idiot moron" if i % 6 == 0 else w for i, w in enumerate(words))
    more = spark.createDataFrame([(10**7, bad, "en", "s", 1), (10**7 + 1, text, "en", "s", 1)], docs.schema)
    kept = drop_toxic(docs.unionByName(more), labels)
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert kept.columns == docs.columns
    assert 10**7 not in ids and 10**7 + 1 in ids


def test_toxic_texts_without_an_id_are_dropped(spark, table):
    docs, labels = table("documents", "sf0.01"), table("labels", "sf0.01")
    text = docs.filter("doc_id = 1").first()["text"]
    bad = " ".join(w + " idiot moron" if i % 6 == 0 else w for i, w in enumerate(text.split()))
    more = spark.createDataFrame([(None, bad, "en", "s", 1), (None, text, "en", "s", 1),
                                  (None, None, "en", "s", 1)], docs.schema)
    kept = drop_toxic(docs.unionByName(more), labels)
    assert kept.columns == docs.columns
    assert {r["text"] for r in kept.filter("doc_id is null").collect()} == {text, None}


def test_scores_of_held_out_texts_are_calibrated(table):
    docs, labels = table("documents", "sf0.1"), table("labels", "sf0.1")
    results = held_out_results(toxicity(docs, labels), labels, "toxic")
    assert sum((t - s) ** 2 for t, _, s in results) / len(results) < 0.03
    found = [t for t, p, _ in results if p == 1]
    assert sum(found) > 0.9 * len(found) and sum(found) > 0.8 * sum(t for t, _, _ in results)


def test_rows_that_share_an_id_are_judged_by_their_own_texts(spark, table):
    docs, labels = table("documents", "sf0.01"), table("labels", "sf0.01")
    text = docs.filter("doc_id = 1").first()["text"]
    bad = " ".join(w + " idiot moron" if i % 6 == 0 else w for i, w in enumerate(text.split()))
    more = spark.createDataFrame([(10**7, bad, "en", "s", 1), (10**7, text, "en", "s", 1)], docs.schema)
    kept = drop_toxic(docs.unionByName(more), labels)
    assert [r["text"] for r in kept.filter(f"doc_id = {10**7}").collect()] == [text]
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()


def test_fitting_takes_few_jobs(spark, table):
    # A job for each level of each tree filled the driver's memory, run after run.
    docs, labels = table("documents", "sf0.01"), table("labels", "sf0.01")
    context = spark.sparkContext
    context.setJobGroup("toxicity in few jobs", "counted")
    try:
        drop_toxic(docs, labels)
        jobs = context.statusTracker().getJobIdsForGroup("toxicity in few jobs")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    assert 0 < len(jobs) < 50
