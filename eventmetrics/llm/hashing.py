"""Hashes of words and of any substring of a block of texts, for whole Arrow columns at a time.

Texts are handled as UTF-8 bytes. One running sum over a block gives the hash of every
substring in constant time, so that words, shingles and character n-grams cost a few array
operations and no Python loop over words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20240131)
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[int, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for blocks of up to n bytes."""
    if len(_POWERS.get(1, ())) < n:
        size = max(n, BLOCK_BYTES + 64)
        _POWERS[1] = _powers(_BASE, size)
        _POWERS[-1] = _powers(pow(_BASE, -1, 1 << 64), size)
    return _POWERS[1], _POWERS[-1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fold_case(codes: np.ndarray) -> np.ndarray:
    """Byte values by which A-Z hash like a-z."""
    codes = codes.copy()
    codes[65:91] = codes[97:123]
    return codes


def _bytes_in(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low:high + 1] = True
    return table


#: Separators of words `[^\x20\x09-\x0D]+`.
SPACES = _bytes_in((0x20, 0x20), (0x09, 0x0D))
#: Separators of words of ASCII letters and digits and all other scripts' characters.
PUNCTUATION = ~_bytes_in((48, 57), (65, 90), (97, 122), (128, 255))
FOLDED = fold_case(_CODES)


@dataclass
class Block:
    """Rows `first` to `first + len(counts)` of a column, as words."""

    first: int
    data: np.ndarray  # their bytes
    offsets: np.ndarray  # where each row's bytes begin, and the end
    starts: np.ndarray  # of each word
    ends: np.ndarray
    counts: np.ndarray  # words of each row
    hashes: np.ndarray  # of each word

    @property
    def bounds(self) -> np.ndarray:
        """Where each row's words begin, and the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def prefix_sums(data: np.ndarray, codes: np.ndarray = FOLDED) -> np.ndarray:
    powers, _ = _power_table(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(codes[data] * powers[:len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each substring; equal bytes give equal hashes wherever they stand."""
    _, inverse = _power_table(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts])


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of words, as `blocks` gives them."""
    data = [np.frombuffer(w.encode(), np.uint8) for w in words]
    return np.array([span_hashes(prefix_sums(d), np.array([0]), np.array([len(d)]))[0]
                     for d in data], np.uint64)


def word_spans(data: np.ndarray, offsets: np.ndarray,
               separators: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word. No word goes over the end of a row."""
    inside = ~separators[data]
    begins, stops = inside.copy(), inside.copy()
    if len(data):
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        edges = np.unique(offsets[(offsets > 0) & (offsets < len(data))])
        begins[edges] = inside[edges]
        stops[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(stops) + 1


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes, and where each row begins (a null row is empty)."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n, at = len(column), column.offset
    offsets = np.frombuffer(column.buffers()[1], np.int64, n + 1, at * 8) if n else np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def row_blocks(offsets: np.ndarray, size: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows with up to `size` bytes together, or one longer row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1
        end = min(max(end, row + 1), n)
        yield row, end
        row = end


def _long_row(data: np.ndarray, separators: np.ndarray, codes: np.ndarray, unicode: bool):
    """Words of one long text, in pieces cut at separators so that memory stays bounded."""
    starts, ends, hashes, at = [], [], [], 0
    while at < len(data):
        stop = min(at + BLOCK_BYTES, len(data))
        while stop < len(data):
            cut = np.flatnonzero(separators[data[max(at, stop - 65536):stop]])
            if len(cut):
                stop = max(at, stop - 65536) + int(cut[-1]) + 1
                break
            stop = min(stop + BLOCK_BYTES, len(data))  # a word of a megabyte
        piece = data[at:stop]
        s, e = word_spans(piece, np.array([0, len(piece)]), separators)
        if unicode:
            s, e = split_ideographs(piece, s, e)
        hashes.append(span_hashes(prefix_sums(piece, codes), s, e))
        starts.append(s + at)
        ends.append(e + at)
        at = stop
    return np.concatenate(starts), np.concatenate(ends), np.concatenate(hashes)


# UTF-8 of punctuation beyond ASCII, by lead bytes and the last byte's range. The
# general and the CJK blocks, Latin-1 signs, and full-width forms.
_PUNCTUATION_2 = ((0xC2, 0x80, 0xA9), (0xC2, 0xAB, 0xB1), (0xC2, 0xB4, 0xB4), (0xC2, 0xB6, 0xB8),
                  (0xC2, 0xBB, 0xBB), (0xC2, 0xBF, 0xBF))
_PUNCTUATION_3 = ((0xE2, 0x80, 0x80, 0xBF), (0xE2, 0x81, 0x80, 0xAF), (0xE3, 0x80, 0x80, 0x84),
                  (0xE3, 0x80, 0x88, 0xA0), (0xEF, 0xBC, 0x81, 0x8F), (0xEF, 0xBC, 0x9A, 0xA0),
                  (0xEF, 0xBD, 0x9B, 0xA5), (0xEF, 0xBB, 0xBF, 0xBF))


def without_punctuation(data: np.ndarray) -> np.ndarray:
    """The bytes with Unicode punctuation and spaces beyond ASCII as ASCII spaces, in as many bytes."""
    lead = np.flatnonzero((data == 0xC2) | (data == 0xE2) | (data == 0xE3) | (data == 0xEF))
    if not len(lead):
        return data
    out = data.copy()
    padded = np.concatenate((data, np.zeros(2, np.uint8)))
    first, second, third = padded[lead], padded[lead + 1], padded[lead + 2]
    for a, low, high in _PUNCTUATION_2:
        at = lead[(first == a) & (second >= low) & (second <= high)]
        out[at] = out[at + 1] = 0x20
    for a, b, low, high in _PUNCTUATION_3:
        at = lead[(first == a) & (second == b) & (third >= low) & (third <= high)]
        out[at] = out[at + 1] = out[at + 2] = 0x20
    return out


def split_ideographs(data: np.ndarray, starts: np.ndarray,
                     ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of words with each character of a script without spaces as a word of its own.

    Those are kana, the ideographs (also those of four bytes), Thai, Lao, Khmer and Burmese; a
    character is known by its first two bytes.
    """
    if not len(data):
        return starts, ends
    after = np.concatenate((data[1:], np.zeros(1, np.uint8)))
    three = (((data == 0xE3) & (after >= 0x81)) | ((data >= 0xE4) & (data <= 0xE9))
             | ((data == 0xE0) & (after >= 0xB8) & (after <= 0xBB))
             | ((data == 0xE1) & ((after == 0x80) | (after == 0x81) | (after == 0x9E) | (after == 0x9F))))
    four = (data == 0xF0) & (after >= 0xA0) & (after <= 0xAF)
    lead = np.concatenate((np.flatnonzero(three), np.flatnonzero(four)))
    if not len(lead):
        return starts, ends
    stop = np.minimum(np.concatenate((np.flatnonzero(three) + 3, np.flatnonzero(four) + 4)), len(data))
    begins, stops = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
    begins[starts] = stops[ends] = True
    inside = np.zeros(len(data) + 2, np.int64)
    np.add.at(inside, starts, 1)
    np.add.at(inside, ends, -1)
    inside = np.cumsum(inside) > 0
    begins[lead] = stops[stop] = True
    cut = lead[(lead > 0) & inside[lead - 1]]  # another word ends before the character
    stops[cut] = True
    cut = stop[inside[stop] & (stop < len(data))]  # and one begins after it
    begins[cut] = True
    return np.flatnonzero(begins), np.flatnonzero(stops)


def blocks(column: pa.Array, separators: np.ndarray = SPACES,
           codes: np.ndarray = FOLDED, unicode: bool = False) -> Iterator[Block]:
    """The rows of a string column as words, block by block. Whole texts, however long.

    With `unicode`, punctuation beyond ASCII separates words as well, and a character of a script
    without spaces is a word.
    """
    data, offsets = column_bytes(column)
    for first, end in row_blocks(offsets):
        part = data[offsets[first]:offsets[end]]
        if unicode:  # a block at a time: its copies of the bytes are small
            part = without_punctuation(part)
        bounds = offsets[first:end + 1] - offsets[first]
        if len(part) > BLOCK_BYTES:
            starts, ends, hashes = _long_row(part, separators, codes, unicode)
        else:
            starts, ends = word_spans(part, bounds, separators)
            if unicode:
                starts, ends = split_ideographs(part, starts, ends)
            hashes = span_hashes(prefix_sums(part, codes), starts, ends)
        counts = np.diff(np.searchsorted(starts, bounds))
        yield Block(first, part, bounds, starts, ends, counts, hashes)


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of `size` words, and how many each row has.

    A row with fewer words has its whole sequence as the only shingle; one without words has
    none. Repeated shingles are repeated here.
    """
    n = len(hashes)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    factor = np.uint64(0xD6E8FEB86659FD93)
    run, power = np.zeros(n, np.uint64), np.uint64(1)
    powers = []
    for k in range(size):
        powers.append(power)
        run[:max(n - k, 0)] += hashes[k:] * power
        power = np.uint64((int(power) * int(factor)) & 0xFFFFFFFFFFFFFFFF)
    run = mix(run)
    numbers = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    keep = np.ones(n, bool)
    for k in range(1, size):  # the last words of a row begin no full run
        last = bounds[1:][counts >= size] - k
        keep[last] = False
    for row in np.flatnonzero((counts > 0) & (counts < size)):
        a, b = bounds[row], bounds[row + 1]
        keep[a + 1:b] = False
        whole = (hashes[a:b] * np.array(powers[:b - a], np.uint64)).sum(keepdims=True)
        run[a] = mix(whole + np.uint64(b - a))[0]
    return run[keep], numbers
