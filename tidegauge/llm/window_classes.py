"""Equal stretches among many short strings, by a sparse suffix array.

Strings are cut where four bytes hash to a multiple of ``SPARSE``, so equal bytes are cut
alike. Only suffixes that begin at a cut are sorted, as sequences of pieces: a piece with
the bytes that determine its end is one symbol, and symbols are numbered in the order of
their bytes, so the order of the suffixes is that of their bytes. Where no cut follows
within ``GAP`` bytes, every byte is a cut.

Any stretch begins at most ``GAP`` bytes before a cut that belongs to it. Two stretches
are equal if the bytes up to that cut are, and the suffixes from there agree in the
others: then no smaller common prefix lies between them in the suffix array.
"""

from __future__ import annotations

import numpy as np

from tidegauge.llm.byte_anchors import Hashes
from tidegauge.llm.suffix_groups import suffix_array
from tidegauge.llm.tokens import ODD, mix

SPARSE = 32
GAP = 150
LOOK = 4
#: Longest symbol: a byte, ``GAP`` bytes without a cut, and what determines that.
WIDTH = GAP + 1 + LOOK


class Cut:
    """Cuts of strings that lie one behind the other in ``data``."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray) -> None:
        self.data, self.bounds = data, bounds
        self.hashes = Hashes(data)
        n = len(data)
        self.ends = np.repeat(bounds[1:], np.diff(bounds))
        looks = self.hashes.of_all(LOOK)
        is_cut = np.zeros(n, dtype=bool)
        is_cut[: len(looks)] = looks % np.uint64(SPARSE) == 0
        places = np.arange(n)
        is_cut &= places + LOOK <= self.ends
        none = n + WIDTH
        following = np.append(np.where(is_cut, places, none), none)
        following = np.minimum.accumulate(following[::-1])[::-1]
        far = (following[:-1] > places + GAP) & (places + GAP + LOOK <= self.ends)
        far |= (following[:-1] >= self.ends) & (places + GAP + LOOK <= self.ends)
        self.at = np.flatnonzero(is_cut | far)
        self.string = np.searchsorted(bounds, self.at, side="right") - 1
        self.end = self.ends[self.at] if n else self.at
        following = np.append(self.at[1:], n)
        last = np.append(self.string[1:] != self.string[:-1], True) if len(self.at) else np.zeros(0, bool)
        # what a symbol is made of: its piece and the bytes that determine the piece's end
        by_cut = np.append(is_cut, False)[following]
        upto = np.where(by_cut, following + LOOK, self.at + WIDTH)
        self.upto = np.where(last, self.end, np.minimum(upto, self.end))

    def symbols(self) -> np.ndarray:
        """The rank of each cut's symbol by its bytes, from 1."""
        _, first, inverse = np.unique(self.hashes.of(self.at, self.upto), return_index=True, return_inverse=True)
        starts, lengths = self.at[first], (self.upto - self.at)[first]
        columns = np.arange(int(lengths.max(initial=1)))
        rows = np.zeros((len(first), len(columns)), dtype=np.uint8)
        for low in range(0, len(first), 1 << 15):
            own = slice(low, low + (1 << 15))
            at = np.minimum(starts[own, None] + columns, len(self.data) - 1)
            # one more than each byte: a text may hold zeros, but no byte of UTF-8 is 255
            rows[own] = np.where(columns < lengths[own, None], self.data[at] + np.uint8(1), 0)
        order = np.argsort(rows.view(f"S{len(columns)}")[:, 0], kind="stable")
        rank = np.empty(len(first), dtype=np.int64)
        rank[order] = np.arange(1, len(first) + 1)
        return rank[inverse]

    def sorted_suffixes(self) -> np.ndarray:
        """Numbers of cuts, in the order of what follows them in their strings."""
        before = self.string + 1  # a separator in front of each string
        n_strings = len(self.bounds) - 1
        text = np.zeros(len(self.at) + n_strings + 1, dtype=np.int64)
        at = np.arange(len(self.at)) + before
        text[at] = self.symbols()
        number = np.empty(len(text), dtype=np.int64)
        number[at] = np.arange(len(self.at))
        return number[suffix_array(text)]

    def common_prefixes(self, order: np.ndarray, most: int) -> np.ndarray:
        """Bytes that each suffix shares with the one before it, ``most`` at the most."""
        padded = np.concatenate([self.data, np.zeros(most + 8, dtype=np.uint8)])
        words = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,))
        one, other = self.at[order[:-1]], self.at[order[1:]]
        limit = np.minimum(self.end[order[:-1]] - one, self.end[order[1:]] - other)
        limit = np.minimum(limit, most)
        common = np.zeros(len(order), dtype=np.int64)
        active = np.arange(len(one))
        for step in range(0, most, 8):
            differ = words[one[active] + step] ^ words[other[active] + step]
            unequal = differ != 0
            lowest = differ[unequal] & (~differ[unequal] + np.uint64(1))
            bits = np.log2(lowest.astype(np.float64)).astype(np.int64)
            common[1 + active[unequal]] = step + bits // 8
            active = active[~unequal]
        common[1 + active] = most
        common[1:] = np.minimum(common[1:], limit)
        return common


def repeated_starts(data: np.ndarray, bounds: np.ndarray, copies: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The starts of all stretches of ``length`` bytes, and which of them occur again.

    Strings lie in ``data`` between ``bounds`` and each stands for ``copies`` equal ones.
    ``length`` is ``WIDTH`` or more.
    """
    cut = Cut(data, bounds)
    places = np.arange(len(data))
    starts = np.flatnonzero(places + length <= cut.ends)
    if not len(starts):
        return starts, np.zeros(0, dtype=bool)
    order = cut.sorted_suffixes()
    common = cut.common_prefixes(order, length)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    passed = np.zeros(len(data) + 1, dtype=np.int64)
    passed[cut.at + 1] = 1
    own = np.cumsum(passed)[starts]  # the first cut from each start on
    lead = cut.at[own] - starts
    by_lead = np.argsort(lead.astype(np.uint16), kind="stable")
    turns = np.searchsorted(lead[by_lead], np.arange(GAP + 2))
    agree = np.empty(len(starts), dtype=np.uint64)
    for before in range(GAP + 1):
        those = by_lead[turns[before] : turns[before + 1]]
        if len(those):
            classes = np.cumsum(common < length - before)
            agree[those] = classes[rank[own[those]]] + before * (len(order) + 1)
    keys = mix(agree * ODD[0] + cut.hashes.of(starts, starts + lead))
    again = np.repeat(copies > 1, np.diff(bounds))[starts]
    ranked = np.sort(keys)
    several = ranked[1:][ranked[1:] == ranked[:-1]]
    if len(several):
        alone = np.flatnonzero(~again)
        at = np.minimum(np.searchsorted(several, keys[alone]), len(several) - 1)
        again[alone] = several[at] == keys[alone]
    return starts, again
