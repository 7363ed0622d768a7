"""Documents drawn by their likeness to a target: hashed n-gram importance resampling.

Words and runs of words are hashed into buckets. A bucket's gain is the logarithm of how much more
often it occurs in the target than in the corpus, a document's weight is the mean gain of its
features, and the documents with the largest weights plus Gumbel noise are drawn, which is
sampling without replacement in proportion to the weights' exponentials. The noise comes from a
hash of the id, so that reruns draw the same documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import map_texts, stored
from eventmetrics.llm.hashing import _bytes_in
from eventmetrics.llm.interning import intern, word_runs
from eventmetrics.llm.ranks import numbered

BUCKETS = 10_000
LONGEST = 1  # words in a feature
SEED = 2024
#: Documents with fewer words are not drawn; of the others, so many in a hundred are.
LEAST_WORDS = 20
PERCENT = 10

_SEPARATORS = _bytes_in((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def _features(column: pa.Array, buckets: int, longest: int):
    """Blocks of runs with the table of the different ones and each one's bucket."""
    for runs in word_runs(column, _SEPARATORS, longest, _FOLD):
        table = intern(runs.data, runs.starts, runs.lengths)
        yield runs, table, table.checksums(runs.data) % buckets


def bucket_counts(docs: DataFrame, text: str = "text", buckets: int = BUCKETS,
                  longest: int = LONGEST) -> DataFrame:
    """bucket and n, the number of features of all texts in it; empty buckets have no row."""

    def run(batches):
        # One array for each task, so that little is shuffled.
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, table, bucket in _features(batch.column(0), buckets, longest):
                np.add.at(total, bucket, table.counts)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(total[found])], ["bucket", "n"])

    return (docs.select(F.col(text).alias("text")).mapInArrow(run, "bucket bigint, n bigint")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
          buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in the target and the corpus."""
    counts = []
    for table, column in ((docs, text), (target, target_text)):
        n = np.zeros(buckets, np.int64)
        for row in bucket_counts(table, column, buckets, longest).collect():  # at most `buckets`
            n[row["bucket"]] = row["n"]
        counts.append(n)
    s, t = counts
    big_s, big_t = int(s.sum()) + buckets, int(t.sum()) + buckets
    return np.floor(1000 * np.log(
        (t + 1.0) * float(big_s) / ((s + 1.0) * float(big_t)))).astype(np.int64)


def _noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel number that the id decides."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, doc_id: str = "doc_id", text: str = "text",
             target_text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST,
             seed: int = SEED, least_words: int = LEAST_WORDS,
             percent: int = PERCENT) -> DataFrame:
    """doc_id, n_features, weight, score and rank (from 1; null if not drawn) of every row.

    Of the rows with at least `least_words` words, `percent` in a hundred (rounded down) with the
    highest scores are drawn, and of equal scores those with the smallest ids. A null text, like an
    empty one, has no features and weight 0. A row without an id has the noise of an empty name
    and comes after others of its score. Rows that repeat each other score alike and have ranks of
    their own. Nulls in the target count as empty; an empty target is uniform.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(  # eight bytes for each bucket
        gains(rows, target, "text", target_text, buckets, longest))

    def run(batch):
        n = batch.num_rows
        words, features, total = (np.zeros(n, np.int64) for _ in range(3))
        for runs, table, bucket in _features(batch.column(1), buckets, longest):
            mine = slice(runs.first, runs.first + runs.rows)
            words[mine] += runs.words
            features[mine] += np.bincount(runs.row, minlength=runs.rows)
            gained = shared.value[bucket][table.slots]
            np.add.at(total[mine], runs.row, gained)
        yield {"doc_id": batch.column(0), "n_words": words, "n_features": features,
               "weight": np.where(features > 0, total // np.maximum(features, 1), 0)}

    scored = stored(map_texts(rows, run, "doc_id bigint, n_words bigint, n_features bigint, "
                                         "weight bigint")
                    .withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)))
    eligible = F.col("n_words") >= least_words
    wanted = scored.filter(eligible).count() * percent // 100
    place = F.col("place") + 1
    ranked = numbered(scored.filter(eligible), [F.desc("score"), F.asc_nulls_last("doc_id")],
                      "place").withColumn("rank", F.when(place <= wanted, place))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    short = scored.filter(~eligible).withColumn("rank", F.lit(None).cast("bigint"))
    return ranked.select(*columns).unionByName(short.select(*columns))
