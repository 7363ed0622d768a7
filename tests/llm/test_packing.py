"""Packing: an exact round trip of all tokens, and little padding."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventmetrics.llm.differencing import difference, windows
from eventmetrics.llm.packing import Tokens, default_tokenizer, pack


def test_differencing_is_a_near_equal_partition():
    chance = random.Random(1)
    sizes = [chance.randrange(1, 512) for _ in range(400)]
    parts = difference(sizes, 40)
    assert sorted(i for part in parts for i in part) == list(range(400))
    sums = [sum(sizes[i] for i in part) for part in parts]
    assert max(sums) - min(sums) <= 16


@pytest.mark.parametrize("sizes", [[], [5], [5, 5], [8] * 9, [1] * 100])
def test_windows_hold_what_fits(sizes):
    parts = windows(sizes, 8)
    assert sorted(i for part in parts for i in part) == list(range(len(sizes)))
    assert all(0 < sum(sizes[i] for i in part) <= 8 for part in parts)


def test_windows_become_more_when_a_capacity_is_exceeded():
    assert len(windows([5, 5, 5], 8)) == 3  # two would hold the sum, but not these sizes


@pytest.mark.parametrize("text", [
    "", " ", "  ", "a  b", "x \ny", "\n\nfoo  bar", "don't I'm", "<|endoftext|> x", "日本 語 ☃",
    "tab\t\tx", "a" * 3000, "été à la plage"])
def test_fast_ids_are_the_tokenizers(text):
    tokens = Tokens(*default_tokenizer())
    ids = Tokenizer.from_file(default_tokenizer()[0]).encode(text, add_special_tokens=False).ids
    assert np.frombuffer(tokens(text), "<u4").tolist() == ids


def check(rows, texts, window=2048):
    """Each token in one piece, sequences without gaps; returns the share of padding."""
    tokenizer = Tokenizer.from_file(default_tokenizer()[0])
    pieces = {}
    for r in rows:
        pieces.setdefault((r["doc_id"], r["doc_tokens"]), []).append(r)
    copies = {}
    for doc, text in texts:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
        copies.setdefault((doc, len(ids)), []).append(ids)
    assert set(pieces) == set(copies)
    for key, found in pieces.items():
        n = len(copies[key])
        ids = copies[key][0]
        starts = sorted(r["start"] for r in found)
        assert sum(r["length"] for r in found) == n * len(ids) and starts[0] == 0
        for r in found:
            part = np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes()
            if all(c == ids for c in copies[key]):
                assert r["ids_crc32"] == zlib.crc32(part)
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / (padding + total)


def test_every_token_is_packed_once(table):
    docs = table("documents", "sf0.01")
    texts = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert check(pack(docs.repartition(2)).collect(), texts) < 0.02


def test_odd_rows_are_packed(odd, none):
    texts = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    check(pack(odd).collect(), texts)
    assert pack(none).count() == 0
    empty = pack(odd.filter("doc_id = 1")).collect()
    assert [(r["start"], r["length"], r["doc_tokens"]) for r in empty] == [(0, 1, 1)]
