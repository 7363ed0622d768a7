"""Benchmark passages in training texts, by spaced seeds that tolerate substituted words.

A seed is a mask over a few consecutive words: the hash covers the words the mask selects and
ignores the others, so a window still matches when an ignored word was changed. Both sides are
hashed under each mask and joined on the hash. Around each hit the passage and the text are then
compared word for word; the best-matching stretch that has enough equal words decides.

Before the join, a bitmap of the passages' hashes removes the training hashes that no passage
has. Its size is fixed, so it may be broadcast whatever the size of the benchmark; with a very
large benchmark it merely removes less. Words are runs of letters and digits; case and
punctuation play no part.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import by_ids, lists, map_texts, stored
from eventmetrics.llm.hashing import PUNCTUATION, blocks, mix

#: Every stretch that counts (see below), wherever its changed words are, has a seed under one of these:
#: it holds one of 455 smallest such patterns of at most 20 words, and the masks fit them all.
MASKS = ("11111", "110111", "1101011", "11100101", "1101000101", "10000100111")
#: Bits of the bitmap: 16 MB.
FILTER_BITS = 1 << 27
_ROW_BITS = 1 << 15  # of one row of bitmap_construct_agg
#: A stretch counts if it has this many equal words, or all of a shorter passage that has
#: SHORT_WORDS, and this percentage of its words is equal.
MATCHED_WORDS, SHORT_WORDS, MATCHED_PERCENT = 8, 5, 70
_MISMATCH = 2.4  # what a changed word costs against equal ones when a stretch is extended


_PLACES = np.random.default_rng(5).integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _seeds(hashes: np.ndarray, counts: np.ndarray, masks):
    """For each mask: hashes of all its windows, their rows and their first words."""
    bounds = np.concatenate(([0], np.cumsum(counts)))
    row = np.repeat(np.arange(len(counts)), counts)
    n = len(hashes)
    for m, mask in enumerate(masks):
        span = len(mask)
        if n < span:
            continue
        total = np.full(n - span + 1, m + 1, np.uint64)
        for k, bit in enumerate(mask):
            if bit == "1":
                total += hashes[k:n - span + 1 + k] * _PLACES[k]
        total = mix(total)
        inside = row[:n - span + 1] == row[span - 1:]
        at = np.flatnonzero(inside)
        yield total[at], row[at], at - bounds[row[at]]


def _seed_rows(batch: pa.RecordBatch, masks, bitmap: np.ndarray | None = None):
    for block in blocks(batch.column(1), PUNCTUATION, unicode=True):
        ids = batch.column(0).slice(block.first, len(block.counts))
        for hashes, rows, places in _seeds(block.hashes, block.counts, masks):
            if bitmap is not None:
                bit = hashes & np.uint64(FILTER_BITS - 1)
                there = bitmap[(bit >> np.uint64(3)).astype(np.int64)] >> (
                    bit & np.uint64(7)).astype(np.uint8) & 1
                kept = np.flatnonzero(there)
                hashes, rows, places = hashes[kept], rows[kept], places[kept]
            if len(hashes):
                yield {"id": ids.take(pa.array(rows)), "seed": hashes.view(np.int64),
                       "place": places}


def _item_words(batch: pa.RecordBatch):
    for block in blocks(batch.column(1), PUNCTUATION, unicode=True):
        yield {"item_id": batch.column(0).slice(block.first, len(block.counts)),
               "item_words": lists(block.hashes.view(np.int64), block.counts)}


def _packed(batch: pa.RecordBatch):
    yield {"part": batch.column(0),
           "bits": [zlib.compress(x.as_buffer(), 1) for x in batch.column(1)]}


def _bitmap_parts(seeds: DataFrame) -> DataFrame:
    """The bitmap in at most FILTER_BITS / _ROW_BITS rows, packed: most bits of most parts are zeros."""
    bit = F.col("seed").bitwiseAND(FILTER_BITS - 1)
    parts = seeds.groupBy(F.shiftright(bit, 15).alias("part")).agg(
        F.bitmap_construct_agg(bit.bitwiseAND(_ROW_BITS - 1)).alias("bits"))
    return map_texts(parts, _packed, "part bigint, bits binary")


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """The fixed-size bitmap of the passages' hashes; put together in parts by Spark."""
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for part, packed in _bitmap_parts(seeds).toLocalIterator():
        at, bits = part * (_ROW_BITS // 8), zlib.decompress(packed)
        out[at:at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _counts(matched: int, length: int, passage: int) -> bool:
    """Whether a stretch with so many equal words is an overlap with a passage of so many words."""
    enough = min(MATCHED_WORDS, max(SHORT_WORDS, passage))
    return matched >= enough and 100 * matched >= MATCHED_PERCENT * length


def _widest(equal: np.ndarray) -> tuple[int, int]:
    """The stretch with most equal words of those with MATCHED_PERCENT; it begins and ends with one."""
    words = np.concatenate(([0], np.cumsum(equal)))
    score = np.concatenate(([0], np.cumsum(np.where(equal, 100, 0) - MATCHED_PERCENT)))
    # For each end, the first place whose score is not higher is where the widest stretch begins.
    begin = np.searchsorted(-np.minimum.accumulate(score), -score)
    end = int(np.argmax(words - words[begin]))
    there = np.flatnonzero(equal[begin[end]:end]) + begin[end]
    return (int(there[0]), int(there[-1]) + 1) if len(there) else (0, 0)


def best_stretch(text: np.ndarray, passage: np.ndarray, shift: int) -> tuple[int, int, int]:
    """Equal words, first word in the text and length of the best-matching stretch that counts.

    If the best-scoring one does not, the one with most equal words is taken; zeros, if none counts.
    `shift` is where in the text the passage's first word would stand.
    """
    low, high = max(0, -shift), min(len(passage), len(text) - shift)
    if high <= low:
        return 0, 0, 0
    equal = passage[low:high] == text[low + shift:high + shift]
    score = np.concatenate(([0.0], np.cumsum(np.where(equal, 1.0, -_MISMATCH))))
    floor = np.minimum.accumulate(score)
    end = int(np.argmax(score - floor))
    start = int(np.flatnonzero(score[:end + 1] == floor[end])[-1]) if end else 0
    matched = int(equal[start:end].sum())
    if not _counts(matched, end - start, len(passage)):
        start, end = _widest(equal)
        wider = int(equal[start:end].sum())
        if _counts(wider, end - start, len(passage)):
            matched = wider
        else:
            return 0, 0, 0
    return matched, low + start + shift, end - start


def _verify(batch: pa.RecordBatch):
    """Columns: doc_id, text, hits (item_id, item_words, shift)."""
    hits = batch.column(2).to_pylist()
    for block in blocks(batch.column(1), PUNCTUATION, unicode=True):
        bounds = block.bounds
        out = {"doc_id": [], "item_id": [], "matched": [], "start": [], "length": []}
        for k in range(len(block.counts)):
            words = block.hashes[bounds[k]:bounds[k + 1]]
            best = {}
            for hit in hits[block.first + k]:
                passage = np.array(hit["item_words"], np.int64).view(np.uint64)
                matched, start, length = best_stretch(words, passage, hit["shift"])
                if matched:
                    best[hit["item_id"]] = max(best.get(hit["item_id"], (0, 0, 0)),
                                               (matched, -start, length))
            for item, (matched, start, length) in best.items():
                for name, value in zip(out, (batch.column(0)[block.first + k].as_py(), item,
                                             matched, -start, length)):
                    out[name].append(value)
        yield out


def benchmark_overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                       text: str = "text", item_id: str = "item_id",
                       item_text: str = "text") -> DataFrame:
    """Each text and benchmark passage that overlap.

    Columns: doc_id, item_id, matched (equal words), start (first word in the text) and length of
    the best-matching stretch. Texts and passages that are null or empty overlap nothing, nor do
    rows without an id. A passage with fewer than eight words must be there word for word; one with
    fewer than five is not looked for. Repeated rows give one row.
    """
    items = benchmark.select(F.col(item_id).cast("bigint").alias("id"),
                             F.lower(F.col(item_text)).alias("text")).filter("id is not null").distinct()
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"),
                       F.lower(F.col(text)).alias("text")).filter("id is not null")
    seeds = stored(map_texts(items, lambda b: _seed_rows(b, MASKS), "id bigint, seed bigint, place bigint"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds))
    found = map_texts(rows, lambda b: _seed_rows(b, MASKS, bitmap.value),
                      "id bigint, seed bigint, place bigint")
    passages = map_texts(items, _item_words, "item_id bigint, item_words array<bigint>")
    hits = (found.join(seeds.select(F.col("id").alias("item_id"), "seed",
                                    F.col("place").alias("item_place")), "seed")
            .select(F.col("id").alias("doc_id"), "item_id",
                    (F.col("place") - F.col("item_place")).alias("shift")).distinct())
    hits = stored(hits)
    by_doc = (hits.join(passages, "item_id")
              .groupBy("doc_id").agg(F.collect_list(
                  F.struct("item_id", "item_words", "shift")).alias("hits")))
    texts = by_ids(rows, "id", hits.select("doc_id")).withColumnRenamed("id", "doc_id")
    both = texts.join(by_doc, "doc_id").select(
        "doc_id", "text", "hits")
    overlaps = map_texts(both, _verify, "doc_id bigint, item_id bigint, matched bigint, "
                         "start bigint, length bigint")
    best = F.max(F.struct("matched", (-F.col("start")).alias("before"), "length")).alias("best")
    return overlaps.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.matched", (-F.col("best.before")).alias("start"), "best.length")


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """One row per document: doc_id, contaminated, n_items, most_matched (0 if none) and kept."""
    per_doc = benchmark_overlaps(docs, benchmark, doc_id, text, item_id, item_text).groupBy(
        "doc_id").agg(F.count("*").alias("n_items"), F.max("matched").alias("most_matched"))
    ids = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"))
    return ids.join(per_doc, "doc_id", "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("most_matched", F.lit(0)).alias("most_matched"),
        F.col("n_items").isNull().alias("kept"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id",
                  text: str = "text", item_id: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The rows of documents that overlap no benchmark passage, with all their columns.

    A row without an id is not compared and is kept.
    """
    found = benchmark_overlaps(docs, benchmark, doc_id, text, item_id, item_text)
    return by_ids(docs, doc_id, found.select("doc_id"), "left_anti")
