"""Toxicity of texts: a forest of trees over a few dense features, calibrated.

The features are rates: words of a fixed and of a learned lexicon, lexicon words near a
second-person word, capitals, punctuation, and spellings that hide a word (digits and signs for
letters). Trees and isotonic calibration are Spark's own, fitted on a bounded sample of labelled
rows; the features of all texts are computed where the texts lie and nothing is shuffled.

The trees of a forest grow together, a job for each level. Boosted trees wait for one another: they
took a job for each level of each tree, and what Spark's driver keeps of so many jobs, and sends out
for each, filled its memory.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from eventmetrics.llm.common import crc_fold, labelled_sample, map_texts, stored
from eventmetrics.llm.hashing import (
    FOLDED,
    PUNCTUATION,
    SPACES,
    blocks,
    hash_words,
    prefix_sums,
    span_hashes,
    word_spans,
)

#: Labelled rows that the model is fitted on at most: those with the smallest hashed ids.
SAMPLE_ROWS = 12_000
FOLDS, HELD_OUT = 5, 0
LEARNED_WORDS = 300
NEAR = 4  # words

INSULTS = (
    "idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash",
    "garbage", "pathetic", "worthless", "clown", "fool", "jerk", "ugly", "disgusting", "hate",
    "kill", "die", "shut", "sucks", "crap", "damn", "hell", "bastard", "bitch", "ass", "asshole",
    "shit", "fuck", "fucking", "dumbass", "imbecile", "vermin", "filth", "lame", "creep", "freak",
    "idiota", "imbécil", "estúpido", "basura", "idiote", "imbécile", "connard", "débile", "ordure",
    "dummkopf", "trottel", "abschaum", "arschloch", "müll", "blödmann",
)
SECOND_PERSON = (
    "you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr",
    "tu", "toi", "ton", "ta", "tes", "vous", "votre", "te", "ti", "tú", "usted", "ustedes", "vosotros",
)

#: Letters that digits and signs stand for, and lower case.
_HIDDEN = FOLDED.copy()
for _sign, _letter in zip(b"013457@$!|", b"oieastasii"):
    _HIDDEN[_sign] = FOLDED[_letter]

FEATURES = ("words", "insults", "insult_count", "learned", "learned_count", "second_person",
            "insults_near_you", "capitals", "capital_words", "exclamations", "punctuation",
            "hidden_insults", "mixed_words")

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_LOUD = np.zeros(256, bool)
_LOUD[[33, 63]] = True
_MARK = PUNCTUATION & ~SPACES
_SIGN = np.zeros(256, bool)
_SIGN[48:58] = True
_SIGN[list(b"@$*#!|")] = True


def _hidden_hashes(words) -> np.ndarray:
    out = []
    for word in words:
        data = np.frombuffer(word.encode(), np.uint8)
        out.append(span_hashes(prefix_sums(data, _HIDDEN), np.array([0]), np.array([len(data)]))[0])
    return np.sort(np.array(out, np.uint64))


def _member(hashes: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    if not len(sorted_set):
        return np.zeros(len(hashes), bool)
    at = np.minimum(np.searchsorted(sorted_set, hashes), len(sorted_set) - 1)
    return sorted_set[at] == hashes


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def _features(batch: pa.RecordBatch, learned: np.ndarray, text_at: int | None):
    """Columns: row, a struct, and, if the text is none of its fields, text."""
    carried = batch.column(0)
    texts = batch.column(1) if text_at is None else carried.field(text_at)
    insults, you = np.sort(hash_words(INSULTS)), np.sort(hash_words(SECOND_PERSON))
    hidden = _hidden_hashes(INSULTS)
    for block in blocks(texts, PUNCTUATION):
        n, bounds = len(block.counts), block.bounds
        words = np.maximum(block.counts, 1)
        insult, second = _member(block.hashes, insults), _member(block.hashes, you)
        taught = _member(block.hashes, learned)
        row = np.repeat(np.arange(n), block.counts)
        near = np.zeros(len(row), bool)
        for step in range(1, NEAR + 1):
            same = row[step:] == row[:-step]
            near[step:] |= second[:-step] & same
            near[:-step] |= second[step:] & same
        bad = insult | taught
        size = np.maximum(np.diff(block.offsets), 1)
        upper = _UPPER[block.data]
        letters = np.maximum(_sums(_LETTER[block.data], block.offsets), 1)
        ups = np.concatenate(([0], np.cumsum(upper)))
        length = block.ends - block.starts
        shouted = (ups[block.ends] - ups[block.starts] == length) & (length > 1)
        # Words between spaces, signs included, for spellings that hide a word.
        loose = _loose(block)
        values = (
            np.log1p(block.counts), _sums(insult, bounds) / words, np.log1p(_sums(insult, bounds)),
            _sums(taught, bounds) / words, np.log1p(_sums(taught, bounds)),
            _sums(second, bounds) / words, _sums(bad & near, bounds) / words,
            _sums(upper, block.offsets) / letters, _sums(shouted, bounds) / words,
            _sums(_LOUD[block.data], block.offsets) / size,
            _sums(_MARK[block.data], block.offsets) / size,
            _sums(_member(loose[0], hidden) & loose[2], loose[1]) / words,
            _sums(loose[2], loose[1]) / words)
        yield {"row": carried.slice(block.first, n), **dict(zip(FEATURES, values))}


def _loose(block):
    """Hashes of the words between spaces with hidden letters shown, their rows' bounds, and
    whether a word mixes letters and signs."""
    starts, ends = word_spans(block.data, block.offsets, SPACES)
    signs = np.concatenate(([0], np.cumsum(_SIGN[block.data])))
    letters = np.concatenate(([0], np.cumsum(_LETTER[block.data])))
    # Marks at the end of a word are punctuation, not part of it.
    while True:
        trailing = (ends - starts > 1) & _MARK[block.data[ends - 1]]
        if not trailing.any():
            break
        ends = ends - trailing
    mixed = (signs[ends] > signs[starts]) & (letters[ends] > letters[starts])
    hashes = np.zeros(len(starts), np.uint64)
    at = np.flatnonzero(mixed)
    if len(at):
        hashes[at] = span_hashes(prefix_sums(block.data, _HIDDEN), starts[at], ends[at])
    return hashes, np.searchsorted(starts, block.offsets), mixed


def _with_features(rows: DataFrame, learned: np.ndarray, text_at: int | None = None) -> DataFrame:
    schema = StructType([rows.schema["row"], *[StructField(f, DoubleType()) for f in FEATURES]])
    return map_texts(rows, lambda b: _features(b, learned, text_at), schema)


def _learned_words(sample: DataFrame) -> np.ndarray:
    """Hashes of the words that mark toxic texts of the sample most clearly."""
    word = F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))),
                                              r"[^\p{L}\p{N}]+")))
    counts = (sample.select("label", word.alias("word")).filter("length(word) between 2 and 40")
              .groupBy("word").agg(F.sum("label").alias("toxic"), F.count("*").alias("all"))
              .filter("toxic >= 3"))
    totals = sample.agg(F.coalesce(F.sum("label"), F.lit(0.0)).alias("toxic"),
                        F.count("*").alias("all")).first()
    clean = max(1.0, totals["all"] - totals["toxic"])
    odds = F.log((F.col("toxic") + 0.5) / (totals["toxic"] + 1)) - F.log(
        (F.col("all") - F.col("toxic") + 0.5) / (clean + 1))
    best = (counts.withColumn("odds", odds).filter("odds > 2")
            .orderBy(F.desc("odds"), F.desc("toxic"), "word").limit(LEARNED_WORDS))
    return np.sort(hash_words([r["word"] for r in best.collect()]))


#: Adds `score` to rows with a struct `row`. The text is the numbered field of it, or a column `text`.
_Scorer = Callable[[DataFrame, int | None], DataFrame]


def _scorer(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str,
            sample_rows: int) -> _Scorer:
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sample = stored(labelled_sample(rows, labels, label, FOLDS, HELD_OUT, sample_rows))
    kinds = {r["label"] for r in sample.select("label").distinct().collect()}
    if kinds != {0.0, 1.0}:
        constant = F.lit(1.0 if kinds == {1.0} else 0.0)
        return lambda df, text_at: df.withColumn("score", constant)
    # Words and trees are learned from one part, and calibrated on rows that neither has seen, if
    # both parts have both labels.
    part = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(3))
    fitting, calibration = sample.filter(part != 0), sample.filter(part == 0)
    if any(half.select("label").distinct().count() < 2 for half in (fitting, calibration)):
        fitting = calibration = sample
    learned = _learned_words(fitting)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")

    def assembled(df: DataFrame, text_at: int | None = None) -> DataFrame:
        return assembler.transform(_with_features(df, learned, text_at))

    def examples(half: DataFrame) -> DataFrame:
        return stored(assembled(half.select(F.struct("label").alias("row"), "text"))
                      .select("row.label", "features"))

    trees = RandomForestClassifier(numTrees=60, maxDepth=10, minInstancesPerNode=2,
                                   featureSubsetStrategy="0.5", seed=4).fit(examples(fitting))
    probability = vector_to_array("probability")[1].alias("raw")
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="score").fit(
        trees.transform(examples(calibration)).select("label", probability))
    return lambda df, text_at: (
        isotonic.transform(trees.transform(assembled(df, text_at)).select("row", probability))
        .select("row", F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score")))


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
             label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of every row.

    Rows whose crc32 of the id, modulo 5, is 0 are held out: their labels are not used. A null
    text is empty, and empty texts get the score of a text without any feature. A row without an
    id is scored and is not held out. Repeated rows get equal scores. If the sample lacks one of
    the two labels, every score is 1 or 0 accordingly (0 without labels).
    """
    number = F.col(doc_id).cast("bigint").alias("doc_id")
    score = _scorer(docs, labels, doc_id, text, label, sample_rows)
    scored = score(docs.select(F.struct(number).alias("row"), F.col(text).alias("text")), None)
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    return scored.select("row.doc_id", "score").select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id",
               text: str = "text") -> DataFrame:
    """The rows of documents that are not predicted toxic, with all their columns.

    Each row is judged by its own text, whatever its id, and is carried through the scoring: nothing
    is joined or shuffled. The types of the columns have to be those that Arrow knows.
    """
    fields = [F.col("`" + c.replace("`", "``") + "`").alias(f"c{k}") for k, c in enumerate(docs.columns)]
    scored = _scorer(docs, labels, doc_id, text, "toxic", SAMPLE_ROWS)(
        docs.select(F.struct(*fields).alias("row")), docs.columns.index(text))
    return scored.filter("score < 0.5").select(
        *[F.col(f"row.c{k}").alias(c) for k, c in enumerate(docs.columns)])
