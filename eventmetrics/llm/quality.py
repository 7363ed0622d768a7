"""Quality of texts by supervised subword embeddings.

Words and character n-grams are hashed to rows of an embedding table, and pairs of equal words in a
row have one more; a text is the mean of its rows, and a softmax layer over it gives the label. Table
and layer are trained together by stochastic gradient descent in numpy, on a bounded sample of
labelled rows. For scoring, the two
fold into one number per row of the table, so a text costs one look-up for each feature.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import crc_fold, labelled_sample, lists, map_texts, stored
from eventmetrics.llm.hashing import SPACES, _CODES, _power_table, blocks, prefix_sums

FOLDS, HELD_OUT = 4, 2
#: Labelled rows that the model is fitted on at most: those with the smallest hashed ids.
SAMPLE_ROWS = 4_000
GRAMS = (3, 4, 5)  # bytes
BUCKETS = 1 << 16  # a quarter of them for words
DIMENSIONS, EPOCHS, RATE = 8, 6, 0.5
THRESHOLD = 0.7

_WORD_BUCKETS = BUCKETS // 4
_REPEATED = 0  # the bucket of every pair of equal words in a row
_GRAM_FACTORS = np.random.default_rng(10).integers(
    1, 1 << 63, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _feature_runs(block):
    """Buckets of features, and for each the byte that it begins with."""
    yield (block.hashes % np.uint64(_WORD_BUCKETS - 1)).astype(np.int64) + 1, block.starts
    again = np.zeros(len(block.starts), bool)
    again[1:] = block.hashes[1:] == block.hashes[:-1]
    again[block.bounds[:-1][block.counts > 0]] = False
    yield np.full(int(again.sum()), _REPEATED), block.starts[again]
    sums = prefix_sums(block.data, _CODES)  # case matters here
    _, inverse = _power_table(len(sums))
    length = block.ends - block.starts
    limit = np.repeat(block.ends, length)
    at = np.arange(len(limit)) + np.repeat(block.starts - (np.cumsum(length) - length), length)
    for n, factor in zip(GRAMS, _GRAM_FACTORS):
        first = at[at + n <= limit]
        value = (sums[first + n] - sums[first]) * inverse[first] * factor
        bucket = (value >> np.uint64(40)) % np.uint64(BUCKETS - _WORD_BUCKETS)
        yield bucket.astype(np.int64) + _WORD_BUCKETS, first


def _bags(batch: pa.RecordBatch):
    """Columns: doc_id, text. Distinct buckets of each text and how often each occurs."""
    for block in blocks(batch.column(1), SPACES, _CODES):
        n = len(block.counts)
        both = np.concatenate([
            (np.searchsorted(block.offsets, first, "right") - 1) * BUCKETS + buckets
            for buckets, first in _feature_runs(block)])
        values, counts = np.unique(both, return_counts=True)
        rows = np.bincount(values // BUCKETS, minlength=n)
        yield {"doc_id": batch.column(0).slice(block.first, n),
               "buckets": lists((values % BUCKETS).astype(np.int32), rows),
               "counts": lists(counts.astype(np.int32), rows)}


class Model:
    """Embeddings of the buckets, and the softmax layer of two labels."""

    def __init__(self, seed: int = 10):
        random = np.random.default_rng(seed)
        self.table = random.uniform(-1, 1, (BUCKETS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
        self.layer = np.zeros((DIMENSIONS, 2), np.float32)
        self.bias = np.zeros(2, np.float32)

    def train(self, texts: list[tuple[np.ndarray, np.ndarray, int]], seed: int = 10) -> None:
        """Texts are buckets (distinct), their shares of the text, and the label."""
        random = np.random.default_rng(seed)
        steps, done = EPOCHS * len(texts), 0
        for _ in range(EPOCHS):
            for i in random.permutation(len(texts)):
                buckets, share, label = texts[i]
                rate = RATE * (1 - done / steps)
                done += 1
                mean = share @ self.table[buckets]
                logits = mean @ self.layer + self.bias
                gradient = np.exp(logits - logits.max())
                gradient /= gradient.sum()
                gradient[label] -= 1
                back = self.layer @ gradient
                self.layer -= rate * np.outer(mean, gradient)
                self.bias -= rate * 0.1 * gradient
                # A bucket's share is small, so its row needs a larger step than the layer.
                self.table[buckets] -= (rate * len(buckets) ** 0.5) * share[:, None] * back

    def folded(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log odds of label 1, and what is added to all."""
        weight = self.layer[:, 1] - self.layer[:, 0]
        return (self.table @ weight).astype(np.float32), float(self.bias[1] - self.bias[0])


def fit(sample: DataFrame) -> Model | None:
    """A model of the sample (doc_id, text, label); None without both labels."""
    bags = map_texts(sample.select("doc_id", "text"), _bags,
                     "doc_id bigint, buckets array<int>, counts array<int>")
    labels = sample.select("doc_id", "label").dropDuplicates(["doc_id"])
    table = stored(bags.join(F.broadcast(labels), "doc_id")).orderBy(
        F.xxhash64("doc_id"), "doc_id").toArrow()
    texts = []
    for chunk in table.to_batches():
        buckets, counts = chunk.column("buckets"), chunk.column("counts")
        for i, label in enumerate(chunk.column("label").to_pylist()):
            n = counts[i].values.to_numpy().astype(np.float32)
            texts.append((buckets[i].values.to_numpy(), n / max(1.0, n.sum()), int(label)))
    if {label for _, _, label in texts} != {0, 1}:
        return None
    model = Model()
    model.train(texts)
    return model


def quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
            label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.7 on) of every row.

    Rows whose crc32 of the id, modulo 4, is 2 are held out: their labels are not used. A null
    text is empty, and an empty text has the score that the layer's bias gives. A row without an
    id is scored and is not held out. Repeated rows get equal scores. If the sample lacks one of
    the two labels, every score is 1 or 0 accordingly (0 without labels).
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sample = stored(labelled_sample(rows, labels, label, FOLDS, HELD_OUT, sample_rows))
    model = fit(sample)
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out")
    if model is None:
        score = F.lit(1.0 if sample.filter("label = 1").limit(1).count() else 0.0)
        return rows.select("doc_id", held_out, score.alias("score"),
                           (score >= THRESHOLD).cast("int").alias("predicted"))
    weights, bias = model.folded()

    def run(batch):
        for block in blocks(batch.column(1), SPACES, _CODES):
            n = len(block.counts)
            total, features = np.zeros(n), np.zeros(n)
            for buckets, first in _feature_runs(block):
                bounds = np.searchsorted(first, block.offsets)
                run_sums = np.concatenate(([0.0], np.cumsum(weights[buckets], dtype=np.float64)))
                total += run_sums[bounds[1:]] - run_sums[bounds[:-1]]
                features += np.diff(bounds)
            odds = np.clip(total / np.maximum(features, 1) + bias, -500, 500)
            yield {"doc_id": batch.column(0).slice(block.first, n), "score": 1 / (1 + np.exp(-odds))}

    scored = map_texts(rows, run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out, "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
