"""Language of texts, words first: known words by their frequency in each language, and unseen
words by shorter and shorter character n-grams.

A word that the model knows counts with its smoothed log frequency in each language. For one that
it does not know, the longest n-grams of which the model knows any decide, by the mean of their
log frequencies. The counts are made by Spark over a bounded sample of texts of each language; the
table that comes out is bounded by the sample and is sent to every task.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmetrics.llm.common import crc_fold, map_texts, stored
from eventmetrics.llm.hashing import BLOCK_BYTES, column_bytes, mix, row_blocks

FOLDS, HELD_OUT = 4, 2
#: Texts of each language that the model learns from, on average: a hash of the id chooses.
TEXTS_PER_LANGUAGE = 2_000
GRAMS = (5, 4, 3, 2, 1)
LEAST = 2  # words and n-grams seen less often are not learned
SMOOTHING = 0.5
UNKNOWN = "und"

_BASE = 0x9E3779B97F4A7C15
_CODES = mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@lru_cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(0x110000)])


@lru_cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        row = np.full(n, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


class _Text:
    """Rows of lower-cased texts as code points, cut into words of letters."""

    def __init__(self, texts: list[str]):
        lowered = [t.lower() for t in texts]
        self.codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.offsets = np.concatenate(([0], np.cumsum([len(t) for t in lowered]))).astype(np.int64)
        n = len(self.codes)
        powers, self.inverse = _powers(max(BLOCK_BYTES + 1, 1 << (n + 1).bit_length()))
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_CODES[self.codes] * powers[:n], out=self.sums[1:])
        inside = _letters()[self.codes]
        begins, stops = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            stops[:-1] &= ~inside[1:]
            edges = self.offsets[(self.offsets > 0) & (self.offsets < n)]
            begins[edges] = inside[edges]
            stops[edges - 1] = inside[edges - 1]
        self.starts, self.ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
        self.row = np.searchsorted(self.offsets, self.starts, "right") - 1

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def grams(self, starts: np.ndarray, ends: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words' n-grams, and the position of the word each belongs to."""
        counts = np.maximum(ends - starts - n + 1, 0)
        word = np.repeat(np.arange(len(starts)), counts)
        first = starts[word] + np.arange(len(word)) - (np.cumsum(counts) - counts)[word]
        return self.hashes(first, first + n) ^ np.uint64(n), word


def _blocks(column: pa.Array):
    _, offsets = column_bytes(column)
    for first, end in row_blocks(offsets):
        texts = column.slice(first, end - first).to_pylist()
        yield first, _Text([t or "" for t in texts])


def _counts(batch: pa.RecordBatch):
    """Columns: lang, text. Counts of words (size 0) and n-grams of each block and language."""
    langs = np.array(batch.column(0).to_pylist(), object)
    for first, text in _blocks(batch.column(1)):
        lang_of_row = langs[first:first + len(text.offsets) - 1]
        names, code = np.unique(lang_of_row.astype(str), return_inverse=True)
        for k, name in enumerate(names):
            mine = code[text.row] == k
            starts, ends = text.starts[mine], text.ends[mine]
            for size in (0, *GRAMS):
                found = text.grams(starts, ends, size)[0] if size else text.hashes(starts, ends)
                values, n = np.unique(found, return_counts=True)
                if len(values):
                    yield {"lang": [name] * len(values), "size": np.full(len(values), size, np.int32),
                           "hash": values.view(np.int64), "n": n.astype(np.int64)}


class Model:
    """Sorted hashes of the known words and n-grams, and their log frequencies by language."""

    def __init__(self, counts: list[tuple[str, int, int, int]] | pa.Table):
        table = counts if isinstance(counts, pa.Table) else pa.Table.from_pylist(
            [dict(zip(("lang", "size", "hash", "n"), r)) for r in counts],
            pa.schema([("lang", pa.string()), ("size", pa.int32()), ("hash", pa.int64()),
                       ("n", pa.int64())]))
        names = np.array(table["lang"].to_pylist(), object).astype(str)
        self.langs, code = np.unique(names, return_inverse=True)
        size, n = table["size"].to_numpy(), table["n"].to_numpy().astype(float)
        hashes = table["hash"].to_numpy().view(np.uint64)
        self.keys, self.logs = {}, {}
        for s in (0, *GRAMS):
            mine = size == s
            keys, place = np.unique(hashes[mine], return_inverse=True)
            seen = np.full((len(keys), len(self.langs)), SMOOTHING)
            np.add.at(seen, (place, code[mine]), n[mine])
            self.keys[s] = keys
            self.logs[s] = np.log(seen / np.maximum(seen.sum(0), 1e-9)).astype(np.float32)

    def look_up(self, size: int, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are known, and the known ones' places."""
        keys = self.keys[size]
        if not len(keys):
            return np.zeros(len(hashes), bool), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        known = keys[at] == hashes
        return known, at[known]

    def word_logs(self, text: _Text) -> np.ndarray:
        """Log frequency of each word in each language; zeros where nothing is known of it."""
        out = np.zeros((len(text.starts), len(self.langs)), np.float32)
        known, at = self.look_up(0, text.hashes(text.starts, text.ends))
        out[known] = self.logs[0][at]
        unseen = np.flatnonzero(~known)
        for size in GRAMS:
            if not len(unseen):
                break
            hashes, word = text.grams(text.starts[unseen], text.ends[unseen], size)
            known, at = self.look_up(size, hashes)
            word = word[known]
            counts = np.bincount(word, minlength=len(unseen))
            found = counts > 0
            for k in range(len(self.langs)):
                total = np.bincount(word, self.logs[size][at, k], len(unseen))
                out[unseen[found], k] = total[found] / counts[found]
            unseen = unseen[~found]
        return out

    def predict(self, text: _Text) -> tuple[list[str | None], np.ndarray]:
        rows, langs = len(text.offsets) - 1, len(self.langs)
        total = np.stack([np.bincount(text.row, weights, rows)
                          for weights in self.word_logs(text).T.astype(float)], 1)
        lead = np.exp(total - total.max(1, keepdims=True))
        share = lead / lead.sum(1, keepdims=True)
        best = total.argmax(1) if langs else np.zeros(rows, int)
        has = np.bincount(text.row, minlength=rows) > 0
        names = [str(self.langs[b]) if h else UNKNOWN for b, h in zip(best, has)]
        return names, np.where(has, share[np.arange(rows), best], 0.0)


def learn(docs: DataFrame, texts_per_language: int) -> Model | None:
    """A model from rows (doc_id, text, lang) outside the held-out fold; None without any."""
    eligible = docs.filter("lang is not null and doc_id is not null").filter(
        crc_fold("doc_id", FOLDS) != HELD_OUT)
    sizes = stored(eligible.groupBy("lang").agg(F.count("*").alias("texts")))
    turn = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = eligible.join(sizes, "lang").filter(turn * F.col("texts") < texts_per_language)
    counts = (map_texts(sample.select("lang", "text").repartition(16), _counts,
                        "lang string, size int, hash bigint, n bigint")
              .groupBy("lang", "size", "hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST))
    table = stored(counts.withColumn("size", F.col("size").cast("int"))).toArrow()
    return Model(table) if table.num_rows else None


def language_id(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                texts_per_language: int = TEXTS_PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred and score (0 to 1) of every row.

    Rows whose crc32 of the id, modulo 4, is 2 are held out: their languages are not used. A null
    text, and one without any letter, is `und` with score 0; so is everything if no row has a
    language to learn from. Of languages that score alike the first by name is taken. A row
    without an id is predicted and is not held out.
    """
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"),
                       F.col(lang).cast("string").alias("lang"))
    model = learn(rows, texts_per_language)
    held_out = F.coalesce(crc_fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))
    if model is None:
        return rows.select("doc_id", held_out.alias("held_out"), F.lit(UNKNOWN).alias("lang_pred"),
                           F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch):
        for first, block in _blocks(batch.column(1)):
            names, score = shared.value.predict(block)
            yield {"doc_id": batch.column(0).slice(first, len(names)), "lang_pred": names,
                   "score": score}

    found = map_texts(rows.select("doc_id", "text"), run,
                      "doc_id bigint, lang_pred string, score double")
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
