"""Runs of words as numbers: an open-addressed table in numpy arrays, one for each block of text.

Keys are xxhash64 values of a run's bytes. A slot belongs to the first run that claimed it, and a
run that comes to a taken slot is the same only if its hash and all its bytes are; otherwise it
goes on to the next slot. What is done once for each different run, such as a checksum, is kept in
the table by slot and gathered for every occurrence.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash

from eventmetrics.llm.hashing import BLOCK_BYTES, column_bytes, row_blocks, word_spans

# The primes of the published hash function.
_P1, _P2, _P3, _P4, _P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63,
    0x27D4EB2F165667C5))
_LANE = 8
_SHORT = 32  # from here on the hash works in stripes, and the library is called


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _lanes(data: np.ndarray, kind: str) -> np.ndarray:
    """The number that begins at each byte of padded data."""
    size = np.dtype(kind).itemsize
    return np.ndarray((len(data) - size + 1,), kind, data, 0, (1,))


def padded(data: np.ndarray) -> np.ndarray:
    """The bytes and a lane of zeros, so that a lane can be read anywhere."""
    return np.concatenate((data, np.zeros(_LANE, np.uint8)))


def xxhash64(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of spans of padded data."""
    eights, fours = _lanes(data, "<u8"), _lanes(data, "<u4")
    out = _P5 + lengths.astype(np.uint64)
    at, left = starts.copy(), lengths.copy()
    for _ in range(_SHORT // _LANE - 1):
        go = np.flatnonzero(left >= _LANE)
        out[go] = _rotl(out[go] ^ (_rotl(eights[at[go]] * _P2, 31) * _P1), 27) * _P1 + _P4
        at[go] += _LANE
        left[go] -= _LANE
    go = np.flatnonzero(left >= 4)
    out[go] = _rotl(out[go] ^ (fours[at[go]].astype(np.uint64) * _P1), 23) * _P2 + _P3
    at[go] += 4
    left[go] -= 4
    for _ in range(3):
        go = np.flatnonzero(left > 0)
        out[go] = _rotl(out[go] ^ (data[at[go]].astype(np.uint64) * _P5), 11) * _P1
        at[go] += 1
        left[go] -= 1
    for shift, prime in ((33, _P2), (29, _P3)):
        out = (out ^ (out >> np.uint64(shift))) * prime
    out ^= out >> np.uint64(32)
    for i in np.flatnonzero(lengths >= _SHORT):
        out[i] = xxhash.xxh64_intdigest(data[starts[i]:starts[i] + lengths[i]].tobytes())
    return out


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the spans of equal lengths at a and b are equal."""
    eights = _lanes(data, "<u8")
    equal = np.ones(len(a), bool)
    left, step = lengths.copy(), 0
    go = np.flatnonzero(left > 0)
    while len(go):
        bits = np.minimum(left[go], _LANE).astype(np.uint64) * np.uint64(8)
        differ = eights[a[go] + step] ^ eights[b[go] + step]
        equal[go] &= (differ << (np.uint64(64) - bits)) == 0
        left[go] -= _LANE
        step += _LANE
        go = go[(left[go] > 0) & equal[go]]
    return equal


@dataclass
class Table:
    """The different spans of a block: for each occurrence its slot, for each slot what it holds."""

    slots: np.ndarray  # of each occurrence, counted from 0 without gaps
    starts: np.ndarray  # of one span of each slot
    lengths: np.ndarray
    counts: np.ndarray

    def checksums(self, data: np.ndarray) -> np.ndarray:
        """crc32 of each slot's bytes."""
        view = memoryview(data)
        return np.fromiter((zlib.crc32(view[a:a + n]) for a, n in zip(
            self.starts.tolist(), self.lengths.tolist())), np.int64, len(self.starts))


def intern(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray,
           hashes: np.ndarray | None = None) -> Table:
    """Find the different spans of padded data."""
    n = len(starts)
    hashes = xxhash64(data, starts, lengths) if hashes is None else hashes
    mask = (1 << max(4, (2 * n).bit_length())) - 1
    owner = np.full(mask + 1, -1, np.int64)
    slot = (hashes & np.uint64(mask)).astype(np.int64)
    open_ = np.arange(n)
    while len(open_):
        at = slot[open_]
        free = owner[at] < 0
        owner[at[free]] = open_[free]  # of several that come at once, one gets the slot
        own = owner[at]
        same = (hashes[own] == hashes[open_]) & (lengths[own] == lengths[open_])
        check = np.flatnonzero(same)
        same[check] = _same_bytes(data, starts[own[check]], starts[open_[check]],
                                  lengths[open_[check]])
        open_ = open_[~same]
        slot[open_] = (slot[open_] + 1) & mask
    used = np.flatnonzero(owner >= 0)
    number = np.zeros(mask + 1, np.int64)
    number[used] = np.arange(len(used))
    slots = number[slot]
    first = owner[used]
    return Table(slots, starts[first], lengths[first], np.bincount(slots, minlength=len(used)))


@dataclass
class Runs:
    """Runs of words of some rows, or of a piece of one: their bytes, spans and rows."""

    first: int  # the rows' place in the column
    rows: int
    words: np.ndarray  # of each row
    data: np.ndarray  # words joined by one space, padded
    starts: np.ndarray
    lengths: np.ndarray
    row: np.ndarray  # of each run


def _runs(first: int, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray,
          size: int, counted: int = 0) -> Runs:
    """All runs of 1 to `size` words but those within the first `counted` words."""
    starts, ends = word_spans(data, offsets, separators)
    row = np.searchsorted(offsets, starts, "right") - 1
    words = np.bincount(row, minlength=len(offsets) - 1)
    words[0] -= counted
    # One separator stays after each word.
    keep = ~separators[data]
    after = ends[ends < len(data)]
    keep[after] = True
    joined = np.where(separators[data], np.uint8(0x20), data)[keep]
    moved = np.concatenate(([0], np.cumsum(keep)))
    starts, ends = moved[starts], moved[ends]
    every = []
    for n in range(1, size + 1):
        begin = np.arange(max(0, len(starts) - n + 1))
        begin = begin[(row[begin] == row[begin + n - 1]) & (begin + n > counted)]
        every.append((starts[begin], ends[begin + n - 1] - starts[begin], row[begin]))
    spans = [np.concatenate(part) for part in zip(*every)]
    return Runs(first, len(offsets) - 1, words, padded(joined), *spans)


def word_runs(column: pa.Array, separators: np.ndarray, size: int,
              fold: np.ndarray) -> Iterator[Runs]:
    """Runs of 1 to `size` words of each row, block by block.

    `fold` maps bytes to the bytes that count. A long row comes in pieces, cut between words, so
    that memory does not grow with a text.
    """
    data, offsets = column_bytes(column)
    for first, end in row_blocks(offsets):
        part = fold[data[offsets[first]:offsets[end]]]
        if len(part) <= BLOCK_BYTES:
            yield _runs(first, part, offsets[first:end + 1] - offsets[first], separators, size)
            continue
        at, counted = 0, 0
        while at < len(part):
            stop = _cut(part, at, separators)
            piece = part[at:stop]
            yield _runs(first, piece, np.array([0, len(piece)]), separators, size, counted)
            # The next piece begins with the last words of this one.
            starts, _ = word_spans(piece, np.array([0, len(piece)]), separators)
            counted = min(size - 1, len(starts)) if stop < len(part) else 0
            at = at + int(starts[-counted]) if counted else stop


def _cut(part: np.ndarray, at: int, separators: np.ndarray) -> int:
    """Where a piece that begins at `at` ends: after a separator, a block further on."""
    stop = min(at + BLOCK_BYTES, len(part))
    while stop < len(part):
        found = np.flatnonzero(separators[part[stop - BLOCK_BYTES // 2:stop]])
        if len(found):
            return stop - BLOCK_BYTES // 2 + int(found[-1]) + 1
        stop = min(stop + BLOCK_BYTES // 2, len(part))
    return stop
