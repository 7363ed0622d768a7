"""The array kernel against Python's own words."""

import re
import tracemalloc

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from eventmetrics.llm import hashing
from eventmetrics.llm.near_dedup import shingle_sets

TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbZ é日\t\n \x0b."), max_size=40)),
                 max_size=12)


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_set(text, size=5):
    found = words(text)
    if not found:
        return set()
    return {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))}


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    column = pa.array(texts, pa.string())
    got, counts = [], []
    for block in hashing.blocks(column):
        got += block.hashes.tolist()
        counts += block.counts.tolist()
    assert counts == [len(words(t)) for t in texts]
    assert got == hashing.hash_words([w for t in texts for w in words(t)]).tolist()


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_sets_have_the_right_sizes_and_overlaps(texts):
    sets = []
    for _, values, counts in shingle_sets(pa.array(texts, pa.string())):
        sets += np.split(values, np.cumsum(counts)[:-1])
    expected = [shingle_set(t) for t in texts]
    assert [len(s) for s in sets] == [len(s) for s in expected]
    for a, x in zip(sets, expected):
        for b, y in zip(sets, expected):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_slices_of_a_column_are_read_where_they_lie():
    column = pa.array(["zero", "one two", None, "three"]).slice(1, 3)
    assert [b.counts.tolist() for b in hashing.blocks(column)] == [[2, 0, 1]]


def test_a_long_text_is_read_in_pieces():
    text = "Ab cd " * 400_000 + "x" * 1_500_000 + " end"
    blocks = list(hashing.blocks(pa.array(["first", text, "last"])))
    assert [b.counts.tolist() for b in blocks] == [[1], [800_002], [1]]
    assert blocks[1].hashes[0] == hashing.hash_words(["ab"])[0]
    assert blocks[1].hashes[-2:].tolist() == hashing.hash_words(["x" * 1_500_000, "end"]).tolist()


def test_unicode_words_take_memory_for_a_block_not_the_batch():
    column = pa.array(["«été» — über… " * 2000] * 1000, pa.large_string())
    size = column.nbytes
    tracemalloc.start()
    try:
        words_found = sum(len(b.hashes) for b in hashing.blocks(column, hashing.PUNCTUATION, unicode=True))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert words_found == 2 * 2000 * 1000
    assert peak < 2 * size + (64 << 20)
