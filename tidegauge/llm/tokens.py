"""Words and word shingles of whole Arrow batches, as 64-bit hashes.

A word is a run of bytes other than space and the control characters 9 to 13; in
UTF-8 these never occur inside another character. All texts of a batch are treated
as one byte array, so nothing loops over words in Python.

Memory is bounded: batches are taken in pieces of ``PIECE_BYTES`` (one longer text is
a piece of its own), and splitting and hashing hold a few numbers per byte of
``HASH_BYTES`` only, besides two places and a hash for each word and shingle.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

PIECE_BYTES = 8 << 20
#: For work that holds many times a piece's bytes and gives the same rows for any pieces.
SMALL_PIECE = 1 << 20
HASH_BYTES = 1 << 18

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Bytes between words where punctuation doesn't count: blanks and all ASCII but letters and digits.
BETWEEN = SPACE.copy()
BETWEEN[[i for i in range(128) if not chr(i).isalnum()]] = True
AS_IS = np.arange(256, dtype=np.uint8)
LOWER = AS_IS.copy()
LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
ODD = np.array(
    [0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB],
    dtype=np.uint64,
)


class Words(NamedTuple):
    """Words of a piece: byte positions, and for each text the index of its first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray


def pieces(batch: pa.RecordBatch, texts: pa.Array, most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` with about ``most`` bytes of ``texts`` each, ``PIECE_BYTES`` if not given; one text per row."""
    most = PIECE_BYTES if most is None else most
    if not batch.num_rows:
        return
    _, bounds = text_bytes(texts)
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the bounds of each text; a null counts as an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(texts) + 1, dtype=np.int64)
    return np.frombuffer(data, dtype=np.uint8)[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_words(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE) -> Words:
    none = np.zeros(0, dtype=np.int64)
    starts, ends = [none], [none]
    inner = bounds[(bounds > 0) & (bounds < len(data))]
    for low in range(0, len(data), HASH_BYTES):
        high = min(low + HASH_BYTES, len(data))
        left, right = max(low - 1, 0), min(high + 1, len(data))
        inside = np.zeros(high - low + 2, dtype=bool)  # one byte more on either side
        inside[left - low + 1 : right - low + 1] = ~space[data[left:right]]
        own = inside[1:-1]
        begins, finishes = own & ~inside[:-2], own & ~inside[2:]
        cuts = inner[np.searchsorted(inner, low) : np.searchsorted(inner, high, side="right")] - low
        after, before = cuts[cuts < high - low], cuts[cuts > 0] - 1
        begins[after] = own[after]  # a word never runs on into the next text
        finishes[before] = own[before]
        starts.append(np.flatnonzero(begins) + low)
        ends.append(np.flatnonzero(finishes) + low + 1)
    first = np.concatenate(starts)
    return Words(data, first, np.concatenate(ends), np.searchsorted(first, bounds))


def words_of(texts: pa.Array) -> Words:
    return split_words(*text_bytes(texts))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values; one to one."""
    values = values ^ (values >> np.uint64(30))
    values = values * ODD[0]
    values = values ^ (values >> np.uint64(27))
    values = values * ODD[1]
    return values ^ (values >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out, out=out)


def hash_words(words: Words, table: np.ndarray = LOWER) -> np.ndarray:
    """A 64-bit hash of each word's bytes after ``table``, the same in every batch."""
    data, starts, ends, _ = words
    out = np.empty(len(starts), dtype=np.uint64)
    at, powers, inverse = 0, _powers(BASE, 0), _powers(BASE_INVERSE, 0)
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + HASH_BYTES)))
        low, high = starts[at], ends[to - 1]
        if high - low > len(powers):
            powers, inverse = _powers(BASE, high - low), _powers(BASE_INVERSE, high - low)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        values = table[data[low:high]].astype(np.uint64) + np.uint64(1)
        np.cumsum(values * powers[: high - low], out=total[1:])
        begin, end = starts[at:to] - low, ends[at:to] - low
        length = (end - begin).astype(np.uint64)
        out[at:to] = mix((total[end] - total[begin]) * inverse[begin] + length * ODD[2])
        at = to
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and for each text the index of its first.

    A text with fewer words gives one shingle of all of them, without words none.
    Repeated shingles are kept.
    """
    n = np.diff(first)
    counts = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    bounds = np.concatenate([[0], np.cumsum(counts)])
    long = n >= size
    short = np.flatnonzero((n > 0) & ~long)
    out = np.empty(bounds[-1], dtype=np.uint64)
    within, at = bounds[-1] - len(short), 0
    runs = np.empty(within, dtype=np.uint64) if len(short) else out
    low, last = first[0], first[-1] - size + 1
    while at < within:
        to = min(low + HASH_BYTES // 8, last)
        every = np.zeros(to - low, dtype=np.uint64)
        for j in range(size):
            every += hashes[low + j : to + j] * ODD[j % 5] * np.uint64(2 * (j // 5) + 1)
        whole = np.ones(to - low, dtype=bool)
        for j in range(1, size):  # a run never goes on into the next text
            whole[first[np.searchsorted(first, low + j) : np.searchsorted(first, to + j)] - j - low] = False
        every = mix(every[whole] + np.uint64(size))
        runs[at : at + len(every)] = every
        at, low = at + len(every), to
    if len(short):
        places = np.ones(len(out), dtype=bool)
        places[bounds[short]] = False
        out[places] = runs
    for i in short:
        own = hashes[first[i] : first[i + 1]]
        weights = ODD[np.arange(len(own)) % 5]
        out[bounds[i]] = mix((own * weights).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(own)))[0]
    return out, bounds


def signed(values: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's signed bigint."""
    return values.view(np.int64)


def list_array(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """A list column with slices of ``values``."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values))
