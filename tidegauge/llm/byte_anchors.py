"""Places of a byte string that are chosen by what surrounds them, as arrays.

The anchor of a stretch of ``LENGTH`` bytes is the place of its smallest hashed run of
``RUN`` bytes, the last one of equals. It depends on the stretch alone, so equal
stretches have their anchors at equal places. Consecutive stretches share anchors; the
bytes of those with one anchor are its context, and every stretch lies in exactly one.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

from tidegauge.llm.tokens import ODD, mix

#: Bytes whose smallest hash makes an anchor; half of the shortest stretch at most.
RUN = 48
#: Bytes of a text that are hashed at a time.
BLOCK_BYTES = 1 << 18

BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _byte_values(seed: int) -> np.ndarray:
    """A fixed odd-looking number for each byte."""
    return mix(np.arange(1, 257, dtype=np.uint64) * ODD[seed])


VALUES = (_byte_values(3), _byte_values(4))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those of a block are kept for the next one."""
    kept = _POWERS.get(base)
    if kept is None or len(kept) < n:
        kept = np.full(n, base, dtype=np.uint64)
        kept[:1] = 1
        np.multiply.accumulate(kept, out=kept)
        if n <= 2 * BLOCK_BYTES:
            _POWERS[base] = kept
    return kept[:n]


class Hashes:
    """Hashes of any stretches of ``data``."""

    def __init__(self, data: np.ndarray, which: int = 0) -> None:
        base, n = BASES[which], len(data) + 1
        self.totals = np.zeros(n, dtype=np.uint64)
        np.cumsum(VALUES[which][data] * _powers(base, n)[:-1], out=self.totals[1:])
        self.inverse = _powers(pow(base, -1, 1 << 64), n)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        totals = self.totals[ends] - self.totals[starts]
        return mix(totals * self.inverse[starts] + (ends - starts).astype(np.uint64) * ODD[2])

    def of_all(self, size: int) -> np.ndarray:
        """Of every stretch of ``size`` bytes."""
        n = len(self.totals) - size
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        lengths = np.full(1, size, dtype=np.uint64) * ODD[2]
        return mix((self.totals[size:] - self.totals[:n]) * self.inverse[:n] + lengths)


class Anchors(NamedTuple):
    """Contexts: text, first and last start of their stretches, anchor, and its hash."""

    text: np.ndarray
    low: np.ndarray
    high: np.ndarray
    place: np.ndarray
    hash: np.ndarray


def smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    return np.minimum(values[: len(values) - (width - size)], values[width - size :])


class Block(NamedTuple):
    """Some of the bytes, where they begin, and the hashes of their stretches."""

    data: np.ndarray
    begin: int
    hashes: Hashes


def anchors_of(data: np.ndarray, bounds: np.ndarray, length: int) -> Iterator[tuple[Block, Anchors]]:
    """Blocks of bytes, each with its anchors.

    Places are those in the block. ``bounds`` are the texts' ends in ``data``; no stretch
    goes over one.
    """
    window = length - RUN + 1
    for begin in range(0, len(data) - length + 1, BLOCK_BYTES):
        block = data[begin : begin + BLOCK_BYTES + length - 1]
        all_hashes = Hashes(block)
        hashes = all_hashes.of_all(RUN)
        place = np.arange(len(hashes), dtype=np.uint64)
        keys = (hashes >> np.uint64(32) << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - place)
        least = smallest(keys, window)
        starts = np.arange(len(least))
        text = np.searchsorted(bounds, starts + begin, side="right") - 1
        whole = starts + begin + length <= bounds[text + 1]
        new = np.ones(len(least), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1]) | ~whole[:-1]
        low = np.flatnonzero(new & whole)
        if not len(low):
            continue
        # a context ends where the next begins or its text has no more stretches
        turns = np.flatnonzero(np.concatenate([new | ~whole, [True]]))
        high = turns[np.searchsorted(turns, low, side="right")] - 1
        place = (np.uint64(0xFFFFFFFF) - (least[low] & np.uint64(0xFFFFFFFF))).astype(np.int64)
        yield Block(block, begin, all_hashes), Anchors(text[low], low, high, place, hashes[place])
